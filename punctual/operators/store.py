"""The per-entity feature table: building, describing and comparing versions of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.clean import utc
from punctual.operators.lookup import attach
from punctual.operators.quantiles import column_medians, group_quantiles
from punctual.session import settle
from punctual.sources.versions import let_out, live_version, publish, read_version


FINDINGS = "subject string, finding string"


class StaleStore(AssertionError):
    """The feature table is older than allowed."""


def build_store(
    rows: DataFrame,
    entity: str,
    *,
    mode: str,
    medians: dict[str, tuple[str, int | None]],
    means: dict[str, tuple[str, int | None]],
    computed_at: Column | None = None,
    unit: str = "km",
    as_of: tuple[str, Column] | None = None,
) -> DataFrame:
    """One row per entity: commonest value of ``mode`` (the smallest on a tie), exact medians, means, row count.

    ``medians`` and ``means`` map an output name to (input column, decimals or None).
    ``as_of`` = (time column, time) leaves out rows from that time on.
    """
    if as_of is not None:
        rows = rows.filter(F.col(as_of[0]) < as_of[1])
    partial = rows.groupBy(entity, mode).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(source).alias(f"_sum_{name}") for name, (source, _) in means.items()],
        *[F.count(source).alias(f"_cnt_{name}") for name, (source, _) in means.items()],
    )
    def rounded(column: Column, digits: int | None) -> Column:
        return column if digits is None else F.bround(column, digits)

    # null is never the mode unless it is all there is
    rank = F.struct(F.col(mode).isNull(), -F.col("_n"), F.col(mode))
    base = partial.groupBy(entity).agg(
        F.min_by(mode, rank).alias(mode),
        *[
            rounded(F.try_divide(F.sum(f"_sum_{n}"), F.sum(f"_cnt_{n}")), digits).alias(n)
            for n, (_, digits) in means.items()
        ],
        F.sum("_n").alias("orders_seen"),
    )
    middle = column_medians(rows, [entity], {n: source for n, (source, _) in medians.items()})
    middle = middle.withColumns({n: rounded(F.col(n), d) for n, (_, d) in medians.items()})
    stamp = utc(F.current_timestamp() if computed_at is None else computed_at.cast("timestamp"))
    return attach(base, middle, entity, null_safe=True).withColumns(
        {"computed_at": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "distance_unit": F.lit(unit)}
    )


def order_store(rows: DataFrame, computed_at: Column | None = None) -> DataFrame:
    """The feature table of the order data."""
    store = build_store(
        rows,
        "restaurant_id",
        mode="city",
        medians={
            "distance_km": ("distance_km", 2),
            "prep_min_estimate": ("restaurant_prep_min_estimate", 1),
            "promised_eta_min": ("promised_eta_min", None),
        },
        means={"courier_rating": ("courier_rating", 2)},
        computed_at=computed_at,
    )
    return store.select(
        "restaurant_id", "city", "distance_km", "prep_min_estimate", "courier_rating",
        "promised_eta_min", "orders_seen", "computed_at", "distance_unit",
    )


def age_seconds(computed_at: str | Column, now: Column | None = None) -> Column:
    column = F.col(computed_at) if isinstance(computed_at, str) else computed_at
    at = F.current_timestamp() if now is None else now
    return F.unix_timestamp(at.cast("timestamp")) - F.unix_timestamp(column.try_cast("timestamp"))


def store_info(store: DataFrame, now: Column | None = None) -> DataFrame:
    """Latest stamp, age, rows and unit as one row; ``mixed`` tells if rows disagree."""
    return store.agg(
        F.max("computed_at").alias("computed_at"),
        F.count(F.lit(1)).alias("rows"),
        F.max("distance_unit").alias("distance_unit"),
        ((F.min("computed_at") != F.max("computed_at")) | (F.min("distance_unit") != F.max("distance_unit"))).alias(
            "mixed"
        ),
    ).withColumn("age_seconds", age_seconds("computed_at", now))


def check_freshness(store: DataFrame, max_age: int = 120, now: Column | None = None) -> dict:
    """Raise StaleStore if the table is older than ``max_age`` seconds; else its age and row count."""
    info = store_info(store, now).first()
    if info["age_seconds"] is None:
        raise StaleStore("feature table has no readable stamp")
    if info["age_seconds"] > max_age:
        raise StaleStore(f"feature table is {info['age_seconds']} s old (limit {max_age} s)")
    return {"age_seconds": info["age_seconds"], "rows": info["rows"]}


def store_drift(
    old: DataFrame,
    new: DataFrame,
    columns: list[str],
    *,
    max_ratio: float = 3.0,
    max_null_rate: float = 0.05,
) -> DataFrame:
    """Per column: median before and after, their ratio, null rate, and what looks wrong.

    A changed unit shows as a median ratio far from 1, a broken upstream join as a null rate.
    """
    def long(df: DataFrame, version: str) -> DataFrame:
        cells = F.array(
            *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns]
        )
        return df.select(F.lit(version).alias("version"), F.inline(cells))

    cells = long(old, "old").unionByName(long(new, "new"))
    rates = cells.groupBy("feature").agg(
        *[
            F.avg(F.when(F.col("version") == v, F.col("value").isNull().cast("double"))).alias(f"{v}_null_rate")
            for v in ("old", "new")
        ]
    )
    medians = group_quantiles(cells, ["feature", "version"], "value", {"median": 0.5})
    medians = medians.groupBy("feature").agg(
        *[F.max(F.when(F.col("version") == v, F.col("median"))).alias(f"{v}_median") for v in ("old", "new")]
    )
    ratio = F.try_divide(F.col("new_median"), F.col("old_median"))
    verdict = (
        F.when(F.col("new_null_rate") > F.greatest(F.col("old_null_rate"), F.lit(max_null_rate)), "nulls")
        .when((F.col("median_ratio") > max_ratio) | (F.col("median_ratio") < 1 / max_ratio), "unit")
        .otherwise("ok")
    )
    joined = rates.join(medians, "feature", "left").withColumn("median_ratio", ratio)
    return joined.withColumn("verdict", verdict)


def publish_checked(
    store: DataFrame, root: str, columns: list[str], *, max_age: int, now: Column | None = None, origin: str | None = None
) -> tuple[int, DataFrame]:
    """Publish a new version of the store behind a gate: its number, and what was found.

    The version is written and announced as held back. What has been written is compared with the version that
    readers have. Only without findings is it let out; otherwise readers stay with what they have. The first
    version has nothing to be compared with but its own stamp and unit.
    """
    spark = store.sparkSession
    before = live_version(spark, root)
    number = publish(store, root, origin, held=True)
    if before is not None and before >= number:
        return number, spark.createDataFrame([], FINDINGS)
    new = read_version(spark, root, number)
    old = new if before is None else read_version(spark, root, before)
    found = settle(store_alarms(old, new, columns, max_age=max_age, now=now))
    if found.limit(1).count() == 0:
        let_out(spark, root, number)
    return number, found


def store_alarms(old: DataFrame, new: DataFrame, columns: list[str], *, max_age: int, now: Column | None = None):
    """Everything about the new version that should stop it from being served, one row per finding."""
    drift = store_drift(old, new, columns).filter(F.col("verdict") != "ok")
    findings = drift.select(F.col("feature").alias("subject"), F.col("verdict").alias("finding"))
    info = store_info(new, now)
    old_unit = old.agg(F.max("distance_unit").alias("u")).scalar()
    stamped = info.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("computed_at").alias("subject"),
                    F.when(F.coalesce(F.col("age_seconds") > max_age, F.lit(True)), "stale").alias("finding"),
                ),
                F.struct(
                    F.lit("distance_unit").alias("subject"),
                    F.when(~F.col("distance_unit").eqNullSafe(old_unit), "unit").alias("finding"),
                ),
            )
        )
    ).filter(F.col("finding").isNotNull())
    return findings.unionByName(stamped)
