"""Scoring requests against the published feature table, one micro-batch at a time."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from punctual.functions.clean import fill_zero, parse_local, parse_utc, to_number, utc
from punctual.functions.calendar import iso_weekday
from punctual.operators.lookup import attach, lookup_with_default
from punctual.operators.store import store_info
from punctual.operators.store_state import StoreSpec, StoreState, finished, merged, state_of
from punctual.session import settle
from punctual.sources.releases import pinned_stores, released
from punctual.sources.versions import (
    delete_folder,
    expire,
    latest_version,
    live_version,
    publish,
    published_origin,
    read_version,
    version_folders,
)
from punctual.streaming.common import write_batch

# What a request may contain, and the profile of an entity nobody has heard of.
ITEMS = (1, 30)
WEATHER = ("clear", "rain", "heavy_rain")
DEFAULT_PROFILE = {"city": "Mumbai", "distance_km": 3.5, "prep_min_estimate": 15.0, "courier_rating": 4.4}


# Folders that the history of a feature table is spread over.
BUCKETS = 256
# The id in the metadata file of a stream.
STREAM_ID = re.compile(r'"id" *: *"([^"]+)"')


def parse_requests(
    raw: DataFrame, body: str = "body", received_at: Column | None = None, *, hour_as_given: bool = True
) -> DataFrame:
    """JSON text to request columns plus ``problem``: null if the request is valid.

    A missing weather is clear, but a null one is refused. A missing, null or empty order time is the time
    of receipt in UTC. Counts may come as whole numbers of any spelling. With ``hour_as_given`` a time
    keeps its own clock, whatever its offset; otherwise it is moved to UTC. Fields are those of
    the outermost object only.
    """

    def field(name: str) -> Column:
        return F.try_variant_get("_v", f"$.{name}", "variant")

    def text(name: str) -> Column:
        """The field if it is text; null if it is missing or anything else."""
        is_text = F.schema_of_variant(field(name)) == "STRING"
        return F.when(is_text, F.try_variant_get("_v", f"$.{name}", "string"))

    def given(name: str) -> Column:
        return field(name).isNotNull()

    parsed = raw.withColumn("_v", F.try_parse_json(body))
    received = utc(F.current_timestamp()) if received_at is None else received_at
    placed = text("placed_at")
    parse = parse_local if hour_as_given else parse_utc
    no_time = ~given("placed_at") | F.coalesce(F.is_variant_null(field("placed_at")), F.lit(False)) | (placed == "")
    number = F.try_variant_get("_v", "$.n_items", "string")
    whole = F.when(number.rlike(r"^\s*[+-]?[0-9]+(\.0*)?\s*$"), F.trim(number).try_cast("double").try_cast("int"))
    columns = {
        "order_id": text("order_id"),
        "restaurant_id": text("restaurant_id"),
        "n_items": whole,
        "weather": F.when(given("weather"), text("weather")).otherwise(F.lit("clear")),
        "placed_utc": F.when(no_time, received).otherwise(parse(placed)),
    }
    problem = (
        F.when(F.col("order_id").isNull(), "order_id")
        .when(F.col("restaurant_id").isNull(), "restaurant_id")
        .when(~F.coalesce(F.col("n_items").between(*ITEMS), F.lit(False)), "n_items")
        .when(~F.coalesce(F.col("weather").isin(*WEATHER), F.lit(False)), "weather")
        .when(F.col("placed_utc").isNull(), "placed_at")
    )
    return parsed.withColumns(columns).drop("_v").withColumn("problem", problem)


def assemble(requests: DataFrame, store: DataFrame, defaults: dict = DEFAULT_PROFILE, *, stored: bool = True) -> DataFrame:
    """Valid requests with the features of their entity, the clock parts and the fallback flags."""
    rows = lookup_with_default(requests, store, "restaurant_id", defaults, stored=stored)
    numeric = [c for c, v in defaults.items() if not isinstance(v, str)]
    rows = rows.withColumns(
        {
            "hour": F.hour("placed_utc"),
            "dow": iso_weekday("placed_utc"),
            **{c: to_number(c) for c in numeric},
        }
    )
    return fill_zero(rows, numeric, "filled")


def respond(
    scored: DataFrame, features: list[str], model_version: Column, computed_at: Column, *also: str | Column
) -> DataFrame:
    """The response row: estimate to 0.1, features used, stamp of the store and the default flag."""
    return scored.select(
        "order_id",
        F.bround("pred", 1).alias("eta_minutes"),
        model_version.alias("model_version"),
        F.struct(*features).alias("features_used"),
        computed_at.alias("store_computed_at"),
        "used_default_profile",
        *also,
    )


def _alert(spark: SparkSession, batch_id: int, version: int | None, age: int | None, max_age: int) -> DataFrame | None:
    """The line about a batch that was served from no store or an old one."""
    if age is not None and age <= max_age:
        return None
    line = [(batch_id, version, age, max_age)]
    return spark.createDataFrame(line, "batch_id long, store_version long, age_seconds long, max_age long")


def score_stream(
    raw: DataFrame,
    store_root: str,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    *,
    body: str = "body",
    defaults: dict = DEFAULT_PROFILE,
    max_age: int = 120,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Validate, look up, score and write every micro-batch.

    Each batch reads the latest published store once and names its version on every row, so no
    row mixes two versions and nothing stale is kept between batches. As long as nothing is published,
    every request is served with the default profile and without a stamp. Bad requests go to
    ``quarantine``; a batch served from no store or one older than ``max_age`` seconds adds a line to
    ``alerts``, but is served all the same.
    """
    spark = raw.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = settle(parse_requests(batch, body))
        write_batch(checked.filter("problem is not null"), os.path.join(out, "quarantine"), batch_id)
        try:
            store = read_version(spark, store_root)
            about = store_info(store).withColumn("store_version", store.agg(F.max("store_version")).scalar()).first()
        except FileNotFoundError:
            nothing = [T.StructField("restaurant_id", T.StringType()), T.StructField("store_version", T.LongType())]
            kinds = [T.StructField(c, T.StringType() if isinstance(v, str) else T.DoubleType()) for c, v in defaults.items()]
            store = spark.createDataFrame([], T.StructType([*nothing, *kinds]))
            about = {"computed_at": None, "store_version": None, "age_seconds": None}
        rows = assemble(checked.filter("problem is null").drop("problem"), store.drop("store_version"), defaults)
        scored = score(rows).withColumns(
            {
                "store_computed_at": F.lit(about["computed_at"]).cast("string"),
                "store_version": F.lit(about["store_version"]).cast("long"),
                "store_age_seconds": F.lit(about["age_seconds"]).cast("long"),
            }
        )
        write_batch(scored, os.path.join(out, "scored"), batch_id)
        alert = _alert(spark, batch_id, about["store_version"], about["age_seconds"], max_age)
        if alert is not None:
            write_batch(alert, os.path.join(out, "alerts"), batch_id)

    return (
        raw.writeStream.foreachBatch(handle)
        .option("checkpointLocation", os.path.join(out, "progress"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def serve_stream(
    raw: DataFrame,
    release_root: str,
    out: str,
    *,
    body: str = "body",
    defaults: dict = DEFAULT_PROFILE,
    max_age: int = 120,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Answer every micro-batch with the released pair of feature table and model.

    A batch reads the pointer once, so all its rows come from one pair, whose three numbers they carry;
    a new pair is served from the next batch on. A model is loaded once and kept, as it never
    changes. Answers go to ``responses``, bad requests to ``quarantine``. As long as nothing is released
    all requests of a batch go there too, with the problem ``no_model``. A batch served from a table older than
    ``max_age`` seconds, or without any, adds a line to ``alerts``. A batch that is run again replaces what it wrote.
    """
    spark = raw.sparkSession
    models: dict = {}

    def handle(batch: DataFrame, batch_id: int) -> None:
        checked = settle(parse_requests(batch, body))
        try:
            pair = released(spark, release_root, models)
        except FileNotFoundError:
            refused = checked.withColumn("problem", F.coalesce("problem", F.lit("no_model")))
            write_batch(refused, os.path.join(out, "quarantine"), batch_id)
            write_batch(_alert(spark, batch_id, None, None, max_age), os.path.join(out, "alerts"), batch_id)
            return
        write_batch(checked.filter("problem is not null"), os.path.join(out, "quarantine"), batch_id)
        about = store_info(pair.store).first()
        rows = assemble(checked.filter("problem is null").drop("problem"), pair.store, defaults)
        numbers = [F.lit(n).cast("long").alias(c) for c, n in (("store_version", pair.store_version), ("release", pair.release))]
        answers = respond(
            pair.model.transform(rows), pair.features, F.lit(pair.model_version).cast("long"),
            F.lit(about["computed_at"]).cast("string"), *numbers,
        )
        # pairs may differ in their features, so these travel as text
        answers = answers.withColumn("features_used", F.to_json("features_used", {"ignoreNullFields": "false"}))
        write_batch(answers, os.path.join(out, "responses"), batch_id)
        alert = _alert(spark, batch_id, pair.store_version, about["age_seconds"], max_age)
        if alert is not None:
            write_batch(alert, os.path.join(out, "alerts"), batch_id)

    return (
        raw.writeStream.foreachBatch(handle)
        .option("checkpointLocation", os.path.join(out, "progress"))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def refresh_store(
    arrivals: DataFrame,
    entity: str,
    build: Callable[[DataFrame], DataFrame],
    store_root: str,
    progress: str,
    *,
    buckets: int = BUCKETS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish a new feature table for every micro-batch, building only what it touches.

    The rows of a batch are added to a history below ``progress``, laid out by bucket of the entity. Only
    the entities of the batch are built anew, from the files of their buckets; the others are taken
    over from the version before. The result equals a build from all rows. A batch that is run again
    replaces its own rows and publishes nothing twice. ``build`` gives one row per entity.

    This takes any ``build``, and a batch that touches all buckets reads all history. A table that is made of
    counts, sums and medians is better kept by ``refresh_merged``, which never reads a row twice.
    """
    spark = arrivals.sparkSession
    history = os.path.join(progress, "history")

    def handle(batch: DataFrame, batch_id: int) -> None:
        # the id of the stream changes with its progress folder, the number of the batch begins anew with it
        stream = spark.read.text(os.path.join(progress, "stream", "metadata")).first()[0]
        origin = f"{STREAM_ID.search(stream)[1]}:{batch_id}"
        bucket = F.pmod(F.xxhash64(entity), F.lit(buckets)).cast("int")
        part = os.path.join(history, f"batch={origin.replace(':', '-')}")
        batch.withColumn("_bucket", bucket).write.mode("overwrite").partitionBy("_bucket").parquet(part)
        kinds = T.StructType([*batch.schema, T.StructField("batch", T.StringType()), T.StructField("_bucket", T.IntegerType())])
        every = spark.read.schema(kinds).parquet(history).drop("batch")
        fresh = spark.read.schema(every.schema).parquet(part)
        touched = settle(fresh.select(entity, "_bucket").distinct())
        found = [r[0] for r in touched.select("_bucket").distinct().collect()]  # at most ``buckets``
        rows = every.filter(F.col("_bucket").isin(found)).drop("_bucket")
        rows = attach(rows, touched.select(entity), entity, "left_semi", null_safe=True)
        store = build(rows)
        if live_version(spark, store_root) is not None:
            before = read_version(spark, store_root).drop("store_version")
            store = store.unionByName(attach(before, touched.select(entity), entity, "left_anti", null_safe=True))
        publish(store, store_root, origin)

    return (
        arrivals.writeStream.foreachBatch(handle)
        .option("checkpointLocation", os.path.join(progress, "stream"))
        .trigger(**(trigger or {"processingTime": "20 seconds"}))
        .start()
    )


PARTS = "counts string, values string, base boolean"


def refresh_merged(
    arrivals: DataFrame,
    spec: StoreSpec,
    store_root: str,
    progress: str,
    *,
    computed_at: Column | None = None,
    parts: int = 16,
    keep: int = 10,
    grace_seconds: float = 3600,
    release_root: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Publish a new feature table for every micro-batch from its own rows and the merged state.

    The state lies below ``progress`` as parts: what each batch adds, and a base. A version of the state is a
    small table that names its parts, published like the feature table. When it names ``parts`` of them the next batch
    merges them with its own to a new base, so the state is rewritten once per ``parts`` batches. Only entities of the batch are
    finished anew; the others are taken over from the version before, or all are finished if that one was
    withdrawn. The result equals a build from all rows. A batch that is run again, or whose progress is lost between the two publications, adds nothing
    twice. Every ``keep`` versions those before the last ``keep`` are removed, and the parts that only they name, once
    readers have had ``grace_seconds``; a table that a release below ``release_root`` names stays.
    """
    spark = arrivals.sparkSession
    state_root, folders = os.path.join(progress, "state"), os.path.join(progress, "parts")

    def read(names: list, column: str, schema: T.StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(*[os.path.join(folders, n[column]) for n in names])

    def put(df: DataFrame) -> str:
        name = uuid.uuid4().hex
        df.sortWithinPartitions(spec.entity).write.option("compression", "zstd").parquet(os.path.join(folders, name))
        return name

    def named_parts() -> set[str]:
        found = spark.read.schema(PARTS).parquet(*version_folders(spark, state_root)).distinct().collect()
        return {r[c] for r in found for c in ("counts", "values")}

    def clean() -> None:
        expire(spark, store_root, keep, grace_seconds, pinned_stores(spark, release_root, store_root) if release_root else ())
        before = named_parts()
        expire(spark, state_root, keep, grace_seconds)
        for name in before - named_parts():
            delete_folder(spark, os.path.join(folders, name))

    def handle(batch: DataFrame, batch_id: int) -> None:
        stream = spark.read.text(os.path.join(progress, "stream", "metadata")).first()[0]
        origin = f"{STREAM_ID.search(stream)[1]}:{batch_id}"
        lot = state_of(batch, spec)
        kinds = lot.counts.schema, lot.values.schema
        try:
            before = [r for r in read_version(spark, state_root).select("counts", "values", "base").collect()]
        except FileNotFoundError:
            before = []
        if published_origin(spark, state_root, origin) is None:
            if len(before) < parts:
                named = [*before, Row(counts=put(lot.counts), values=put(lot.values), base=False)]
            else:
                sides = zip(("counts", "values"), kinds, (lot.counts, lot.values), strict=True)
                whole = merged(StoreState(*[read(before, c, k).unionByName(df) for c, k, df in sides]), spec)
                named = [Row(counts=put(whole.counts), values=put(whole.values), base=True)]
            lines = [(r["counts"], r["values"], r["base"]) for r in named]
            publish(spark.createDataFrame(lines, PARTS).coalesce(1), state_root, origin)
        now = [r for r in read_version(spark, state_root).select("counts", "values", "base").collect()]
        touched = settle(batch.select(spec.entity).distinct())
        every = StoreState(read(now, "counts", kinds[0]), read(now, "values", kinds[1]))
        live = live_version(spark, store_root)
        if live is None or live != latest_version(spark, store_root):
            # nothing to take over, or a version was withdrawn with what its batch had touched
            store = finished(merged(every, spec), spec, computed_at)
        else:
            own = [attach(df, touched, spec.entity, "left_semi", null_safe=True) for df in (every.counts, every.values)]
            store = finished(merged(StoreState(*own), spec), spec, computed_at)
            old = read_version(spark, store_root).drop("store_version")
            store = store.unionByName(attach(old, touched, spec.entity, "left_anti", null_safe=True))
        if publish(store, store_root, origin) % keep == 0:
            clean()

    return (
        arrivals.writeStream.foreachBatch(handle)
        .option("checkpointLocation", os.path.join(progress, "stream"))
        .trigger(**(trigger or {"processingTime": "20 seconds"}))
        .start()
    )
