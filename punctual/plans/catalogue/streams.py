"""Streaming jobs fed from the given files, compared with what a batch query says."""

from __future__ import annotations

import os

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.clean import utc
from punctual.functions.scores import mae
from punctual.operators.split import time_split
from punctual.plans.catalogue.adapters import EVENTS, HOLDOUT_DAYS, LONG_HOLDOUT_DAYS, events, hundredths, rules_minutes, sides, table
from punctual.plans.catalogue.history import STAMP, USER_STORE, store_sql, user_store
from punctual.plans.catalogue.quality import request_bodies
from punctual.plans.catalogue.registry import query
from punctual.functions.calendar import iso_weekday
from punctual.plans.training import fit_tree, score
from punctual.session import shared_path
from punctual.sources.releases import publish_model, release
from punctual.sources.versions import publish, read_version
from punctual.streaming.common import drain, drained, event_time, file_stream, state_in_rocksdb
from punctual.streaming.orders import (
    CANCELLED,
    DELIVERED,
    PLACED,
    bias_by_window,
    deliveries,
    drop_twins,
    order_outcomes,
    orders_in_flight,
    windows_so_far,
)
from punctual.streaming.requests import refresh_merged, score_stream, serve_stream


#: Rows of a file in an inbox. A file is often one row group, which one task reads, however many rows it has.
FILE_ROWS = 100_000


def arrive(lot: DataFrame, inbox: str) -> None:
    """Add a lot to an inbox, in files that all tasks of its batch can share."""
    lot.write.option("maxRecordsPerFile", FILE_ROWS).mode("append").parquet(inbox)


def event_files(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream, be it one file or a folder of files."""
    events_table = table(spark, sf, "events")
    first = events_table.select("_metadata.file_path").first()
    if first is not None and first[0].endswith("/events.parquet"):
        return file_stream(spark, sf, events_table.schema, pattern="events.parquet")
    return file_stream(spark, f"{sf.rstrip('/')}/events.parquet", events_table.schema)


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Arriving events with a zoned event time and the rules' estimate."""
    return event_time(event_files(spark, sf), "ts").withColumns(
        {
            "value": hundredths("value"),
            "k": F.get_json_object("props", "$.k").cast("int"),
            "hour": F.hour("ts"),
            "dow": iso_weekday("ts"),
        }
    ).withColumn("pred", rules_minutes())


def _rows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out, "rows"))


WINDOWS = "window_start timestamp, rows long, bias double, mae double"


def _windows(spark: SparkSession, out: str, arrived: DataFrame) -> DataFrame:
    found = windows_so_far(drained(spark, out, WINDOWS), arrived, "ts", "pred", "value")
    return found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query(
    f"""
    with {EVENTS}
    select date_trunc('day', ts)::timestamp as window_start, count(*) as rows, avg(pred - value) as bias,
           avg(abs(pred - value)) as mae,
           date_trunc('day', min(ts)) + interval 1 day <= (select max(ts) from ev) - interval 1 hour as closed,
           cast(0 as bigint) as late_rows
    from ev group by 1
    """
)
def stream_daily_bias(spark: SparkSession, sf: str) -> DataFrame:
    """Bias per day: closed days as the stream emitted them, the days that are still open from a batch read."""
    out = shared_path(spark, "daily-bias")
    drain(bias_by_window(event_stream(spark, sf), "ts", "pred", "value"), out)
    return _windows(spark, out, event_time(events(spark, sf), "ts"))


@query(
    f"""
    with {EVENTS},
    mark as (select max(case when event_type <> 'error' then ts end) - interval 1 hour as early, max(ts) - interval 1 hour as late from ev),
    d as (
      select *, date_trunc('day', ts)::timestamp as day,
             event_type = 'error' and date_trunc('day', ts) + interval 1 day <= (select early from mark) as dropped
      from ev
    )
    select day as window_start, count(*) filter (not dropped) as rows, avg(pred - value) filter (not dropped) as bias,
           avg(abs(pred - value)) filter (not dropped) as mae, day + interval 1 day <= (select late from mark) as closed,
           count(*) filter (dropped) as late_rows
    from d group by day
    """
)
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Failures arrive after all other events: those of closed days are dropped and stand in the ledger of their day."""
    out, inbox = shared_path(spark, "late-bias"), shared_path(spark, "inbox")
    rows = events(spark, sf)
    for lot in (rows.filter("event_type <> 'error'"), rows.filter("event_type = 'error'")):
        arrive(lot, inbox)
        arriving = event_time(file_stream(spark, inbox, rows.schema), "ts")
        drain(bias_by_window(arriving, "ts", "pred", "value"), out)
    return _windows(spark, out, event_time(rows, "ts"))


@query("select event_id, user_id, event_type, floor(value * 100 + 0.5::double) as value from events")
def stream_drop_twins(spark: SparkSession, sf: str) -> DataFrame:
    """Every event written twice by its source; one of each comes out."""
    out = shared_path(spark, "twins")
    once, again = event_stream(spark, sf), event_stream(spark, sf)
    single = drop_twins(once.unionByName(again), ["event_id", "user_id", "event_type", "ts"], "ts")
    drain(single.select("event_id", "user_id", "event_type", "value"), out)
    return _rows(spark, out)


@query(
    f"""
    with {EVENTS}
    select event_id, user_id, k * 10 / 1.0::double as actual_minutes from ev
    where event_type <> 'error' and k * 10 > 0 and k * 10 < 720
    """
)
def stream_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Each order is placed, and unless it fails delivered k x 10 minutes later; one row per
    order delivered within twelve hours."""
    out = shared_path(spark, "deliveries")
    placed = event_stream(spark, sf).select("event_id", "user_id", F.col("ts").alias("placed_at"))
    delivered = (
        event_stream(spark, sf)
        .filter("event_type <> 'error'")
        .select("event_id", F.timestamp_add("MINUTE", F.col("k") * 10, F.col("ts")).alias("delivered_at"))
    )
    matched = deliveries(placed, delivered, on=["event_id"], placed_at="placed_at", delivered_at="delivered_at")
    drain(matched.select("event_id", "user_id", "actual_minutes"), out)
    return _rows(spark, out)


@query(
    f"""
    with {EVENTS},
    s as (
      select event_id, ts, case when event_type = 'error' then ts + interval 5 minute
                                when event_type <> 'signup' then ts + k * interval 10 minute end as ended, event_type, k
      from ev
    ),
    mark as (select greatest(max(ts), max(ended)) - interval 1 hour as until from s)
    select event_id,
           case when event_type = 'error' then 'cancelled'
                when event_type = 'signup' then case when ts + interval 720 minute <= (select until from mark) then 'timed_out' else 'in_flight' end
                when k <= 0 then 'not_positive' when k * 10 >= 720 then 'timed_out' else 'delivered' end as outcome,
           case when event_type not in ('error', 'signup') and k * 10 < 720 then k * 10.0::double end as actual_minutes
    from s
    """
)
def stream_order_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Every order in the state, with the time its timer runs to: delivered, cancelled, timed out, or still in flight there.

    A failed event is an order cancelled after five minutes, a sign-up one that nothing more is heard of.
    """
    out = shared_path(spark, "outcomes")
    end = F.when(F.col("event_type") == "error", F.timestamp_add("MINUTE", F.lit(5), "ts")).when(
        F.col("event_type") != "signup", F.timestamp_add("MINUTE", F.col("k") * 10, "ts")
    )
    kind = F.when(F.col("event_type") == "error", CANCELLED).otherwise(DELIVERED)
    steps = F.array(F.struct(F.lit(PLACED).alias("kind"), F.col("ts").alias("at")), F.struct(kind.alias("kind"), end.alias("at")))
    arriving = event_stream(spark, sf).select("event_id", F.inline(steps)).filter("at is not null")
    with state_in_rocksdb(spark):
        drain(order_outcomes(arriving, ["event_id"]), out)
    ended = drained(spark, out, "event_id long, outcome string, placed_at timestamp, actual_minutes double")
    every = ended.unionByName(orders_in_flight(spark, os.path.join(out, "progress")))
    return every.select("event_id", "outcome", "actual_minutes")


SCORED_DEFAULTS = {"event_type": "none", "k": 50.0}


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)}, {store_sql('tr', 'store')},
    rq as (select event_id, user_id, ts from ev where k between 1 and 30 and event_type <> 'error'),
    x as (select rq.event_id, s.user_id is null as used_default_profile,
                 case when s.user_id is null then 50.0 else s.k end as k,
                 case when s.user_id is null then 'none' else s.event_type end as event_type,
                 hour(rq.ts) as hour
          from rq left join store s on rq.user_id = s.user_id)
    select concat('E', event_id) as order_id, used_default_profile,
           2000.0 + k * 50.0 + case when event_type = 'purchase' then 500.0 else 0.0 end
           + case when hour in (12, 13, 19, 20) then 1000.0 else 0.0 end as pred,
           cast(1 as bigint) as store_version
    from x
    """
)
def stream_scored_by_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Requests scored by a function against the published store; every row names its version."""
    root, out, inbox = (shared_path(spark, n) for n in ("store", "scored", "inbox"))
    train = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)[0]
    store = user_store(train).withColumn("restaurant_id", F.col("user_id").cast("string"))
    publish(store.select("restaurant_id", "event_type", "k", "computed_at", "distance_unit"), root)
    bodies = request_bodies(spark, sf).select("body")
    arrive(bodies, inbox)
    arriving = file_stream(spark, inbox, bodies.schema)
    score_stream(
        arriving, root, lambda rows: rows.withColumn("pred", rules_minutes()), out, defaults=SCORED_DEFAULTS
    ).awaitTermination()
    scored = spark.read.parquet(os.path.join(out, "scored"))
    return scored.select("order_id", "used_default_profile", "pred", F.col("store_version").cast("long").alias("store_version"))


SERVED_DEFAULTS = {"event_type": "view", "k": 50.0}
RULES_MODEL = (
    "SELECT *, 2000.0D + k * 50.0D + CASE WHEN event_type = 'purchase' THEN 500.0D ELSE 0.0D END"
    " + CASE WHEN hour IN (12, 13, 19, 20) THEN 1000.0D ELSE 0.0D END AS pred FROM __THIS__"
)


def _served(spark: SparkSession, sf: str) -> str:
    """Requests arrive in two lots. Between them a new table and a fitted model take the place of the rules."""
    store, models, pairs, out, inbox = (shared_path(spark, n) for n in ("store", "models", "pairs", "served", "inbox"))
    rows = events(spark, sf)

    def put(days: int, stamp: Column) -> DataFrame:
        train = time_split(rows, "ts", days)[0]
        table_ = user_store(train).withColumns({"restaurant_id": F.col("user_id").cast("string"), "computed_at": stamp})
        publish(table_.select("restaurant_id", "event_type", "k", "computed_at", "distance_unit"), store)
        return train

    def answer(lot: DataFrame) -> None:
        arrive(lot.select("body"), inbox)
        serve_stream(file_stream(spark, inbox, "body string"), pairs, out, defaults=SERVED_DEFAULTS).awaitTermination()

    early, late = time_split(request_bodies(spark, sf), "ts", HOLDOUT_DAYS)
    put(LONG_HOLDOUT_DAYS, F.lit(STAMP))
    rules = Pipeline(stages=[SQLTransformer(statement=RULES_MODEL)]).fit(rows)
    publish_model(rules, models, ["k", "event_type", "hour"])
    release(spark, pairs, store, models)
    answer(early)
    train = put(HOLDOUT_DAYS, F.date_format(utc(F.current_timestamp()), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    train = train.select("event_type", "value")
    # a tree over one category learns the mean of each, which SQL can state
    tree = fit_tree(train, ["event_type"], "value", categorical=["event_type"])
    publish_model(tree, models, ["event_type"], score(tree, train).agg(mae("pred", "value").alias("model_mae")))
    release(spark, pairs, store, models)
    answer(late)
    return out


SERVED = f"""{EVENTS}, cut as (select max(ts) - interval {HOLDOUT_DAYS} day as cut_at from ev),
    first_cut as (select max(ts) - interval {LONG_HOLDOUT_DAYS} day as cut_at from ev),
    tr1 as (select * from ev where ts < (select cut_at from first_cut)), tr2 as (select * from ev where ts < (select cut_at from cut)),
    {store_sql('tr1', 'store1')}, {store_sql('tr2', 'store2')},
    learned as (select event_type, avg(value) as pred from tr2 group by event_type),
    rq as (select *, case when ts < (select cut_at from cut) then 1 else 2 end as lot,
                  case when not (k between 1 and 30) then 'n_items' when event_type = 'error' then 'weather' end as problem from ev),
    known as (
      select rq.event_id, rq.lot, hour(rq.ts) as hour, case lot when 1 then s1.user_id else s2.user_id end is null as used_default_profile,
             coalesce(case lot when 1 then s1.event_type else s2.event_type end, 'view') as event_type,
             coalesce(case lot when 1 then s1.k else s2.k end, 50.0) as k
      from rq left join store1 s1 on rq.user_id = s1.user_id left join store2 s2 on rq.user_id = s2.user_id where problem is null
    )"""


@query(
    f"""
    with {SERVED}
    select concat('E', event_id) as order_id, used_default_profile,
           round(case lot when 1 then 2000.0::double + known.k * 50.0::double + case when known.event_type = 'purchase' then 500.0 else 0.0 end
                                      + case when hour in (12, 13, 19, 20) then 1000.0 else 0.0 end
                          else learned.pred end, 1) as eta_minutes,
           lot::bigint as store_version, lot::bigint as model_version, lot::bigint as release
    from known join learned on known.event_type = learned.event_type
    """
)
def stream_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Requests scored with the released pair of table and model, which is replaced between two batches."""
    answers = spark.read.parquet(os.path.join(_served(spark, sf), "responses"))
    return answers.select("order_id", "used_default_profile", F.round("eta_minutes", 1).alias("eta_minutes"), "store_version", "model_version", "release")


@query(
    f"""
    with {SERVED}
    select concat('E', event_id) as order_id, used_default_profile, known.event_type as served_type,
           case lot when 1 then known.k end as served_k, case lot when 1 then hour::double end as served_hour,
           case lot when 1 then '{STAMP}' end as first_stamp
    from known
    """
)
def stream_responses(spark: SparkSession, sf: str) -> DataFrame:
    """The features that each answer was computed from, and the stamp of the table: of the first lot a fixed one."""
    answers = spark.read.parquet(os.path.join(_served(spark, sf), "responses"))
    used = F.from_json("features_used", "event_type string, k double, hour bigint")
    return answers.select(
        "order_id", "used_default_profile", used["event_type"].alias("served_type"), used["k"].alias("served_k"),
        used["hour"].cast("double").alias("served_hour"), F.when(F.col("release") == 1, F.col("store_computed_at")).alias("first_stamp"),
    )


@query(
    f"""
    with {SERVED}
    select concat('E', event_id) as order_id, problem, (lot - 1)::int as batch from rq where problem is not null
    """
)
def stream_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """T5: the requests that were refused, and why."""
    refused = spark.read.parquet(os.path.join(_served(spark, sf), "quarantine"))
    return refused.select("order_id", "problem", F.col("batch").cast("int").alias("batch"))


@query("select cast(0 as bigint) as batch_id, cast(1 as bigint) as store_version, true as too_old, cast(120 as bigint) as max_age")
def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """T4: the batch that was served from an old table has an alert, the one from a fresh table has none."""
    alerts = spark.read.parquet(os.path.join(_served(spark, sf), "alerts"))
    return alerts.select("batch_id", "store_version", (F.col("age_seconds") > F.col("max_age")).alias("too_old"), "max_age")


@query(
    f"""
    with {EVENTS}, {store_sql('ev', 'store')}
    select user_id, event_type, value, k, orders_seen, cast(2 as bigint) as store_version from store
    """
)
def stream_refreshed_store(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive in two lots; the second is merged into the state of the first."""
    root, progress, inbox = (shared_path(spark, n) for n in ("store", "progress", "inbox"))
    rows = events(spark, sf)
    early, late = time_split(rows, "ts", HOLDOUT_DAYS)
    for lot in (early, late):
        arrive(lot, inbox)
        arrivals = file_stream(spark, inbox, rows.schema)
        refresh_merged(arrivals, USER_STORE, root, progress, computed_at=F.lit(STAMP), trigger={"availableNow": True}).awaitTermination()
    latest = read_version(spark, root)
    return latest.select(
        "user_id", "event_type", "value", "k", "orders_seen", F.col("store_version").cast("long").alias("store_version")
    )
