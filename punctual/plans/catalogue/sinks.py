"""What is written is read back: run log, metrics, review sheet, model, and the audit of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.audit import added_columns, column_catalogue
from punctual.operators.evaluation import regression_report
from punctual.operators.runs import latest_runs
from punctual.operators.sampling import borderline_sheet
from punctual.operators.split import time_split
from punctual.plans.catalogue.adapters import EVENTS, HOLDOUT_DAYS, RAW_ORDERS, RAW_RULES, events, raw_orders, sides
from punctual.plans.catalogue.quality import RUNS_SQL, _runs
from punctual.plans.catalogue.registry import query
from punctual.plans.training import fit_regressor, load_model, save_model, score
from punctual.operators.labels import label
from punctual.session import shared_path
from punctual.sources.tables import append_metrics, append_runs, read_csv, write_csv


@query(f"with {RUNS_SQL} select name, mae, data_sha, cast(1 as bigint) as rows from runs")
def run_log(spark: SparkSession, sf: str) -> DataFrame:
    """K7: runs appended twice; the last of each name, and that there is one."""
    path = shared_path(spark, "runs")
    for _ in range(2):
        append_runs(_runs(spark, sf), path)
    last = latest_runs(spark.read.parquet(path))
    return last.groupBy("name").agg(
        F.max(F.col("metrics")["mae"]).alias("mae"), F.max(F.col("params")["data_sha"]).alias("data_sha"),
        F.count(F.lit(1)).alias("rows"),
    )


@query(f"with {EVENTS} select event_type, count(*) as n, avg(abs(pred - value)) as mae from ev group by event_type")
def metrics_file(spark: SparkSession, sf: str) -> DataFrame:
    """K5: a report added to a JSON table and read back."""
    path = shared_path(spark, "metrics")
    append_metrics(regression_report(events(spark, sf), "pred", "value", ["event_type"]), path)
    return spark.read.schema("event_type string, n bigint, mae double").json(path)


@query(
    f"""
    with {EVENTS}
    select event_id, event_type, hour, k, pred, value, null::varchar as acceptable
    from ev where abs(value - pred) <= 600
    order by md5(concat('8', event_id)), event_id limit 20
    """
)
def review_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet for a reviewer as CSV, read with its declared schema; empty answers are null."""
    path = shared_path(spark, "sheet")
    columns = ["event_id", "event_type", "hour", "k", "pred", "value"]
    write_csv(borderline_sheet(events(spark, sf), "event_id", "value", "pred", columns, band=600), path)
    kinds = "event_id bigint, event_type string, hour int, k int, pred double, value double, acceptable string"
    return read_csv(spark, path, kinds)


@query(f"with {EVENTS}, {sides(HOLDOUT_DAYS)} select count(*) as rows, count(*) as same, true as recorded from te")
def saved_model(spark: SparkSession, sf: str) -> DataFrame:
    """A model on a column of many categories, saved, loaded and scored again."""
    train, test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)
    features = ["k", "user_id"]
    fitted = fit_regressor(train, features, "value", categorical=["user_id"])
    path, log = shared_path(spark, "model"), shared_path(spark, "models")
    save_model(fitted, path, regression_report(score(fitted, test.drop("pred")), "pred", "value"), log, features)
    first = score(fitted, test.drop("pred")).select("event_id", F.col("pred").alias("a"))
    again = score(load_model(path), test.drop("pred")).select("event_id", F.col("pred").alias("b"))
    known = spark.read.parquet(log).agg(F.max(F.col("path") == path)).scalar()
    both = first.join(again, "event_id")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("a") == F.col("b")).alias("same")).withColumn("recorded", known)


@query(
    f"""
    with {RAW_ORDERS},
    n as (select count(*) as n, count(delivered_at) as d from raw_orders)
    select 'city' as column, 'order_time' as availability, false as leaks, n as filled from n
    union all select 'delivered_at', 'post_outcome', true, d from n
    union all select 'picked_up_at', 'in_progress', true, n from n
    union all select unnest(['order_id', 'placed_at', 'restaurant_id', 'courier_id', 'status', 'discount']), 'derived', false, n from n
    """
)
def leakage_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Q3 2.9-14: when each column of the order log is known, and how many rows have it."""
    orders = raw_orders(spark, sf)
    about = column_catalogue(spark, orders).select("column", "availability", "leaks")
    counts = orders.agg(*[F.count(c).alias(c) for c in orders.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in orders.columns])
    return about.join(F.broadcast(counts.select(F.inline(pairs))), "column")  # a line per column


@query(
    f"""
    with {RAW_ORDERS}, n as (select count(*) as n from ranked where rn = 1)
    select unnest(['placed_utc', 'actual_minutes', 'hour', 'dow', 'doy', 'severely_late']) as added, n as rows from n
    """
)
def label_columns(spark: SparkSession, sf: str) -> DataFrame:
    """What labelling adds to the order log, and for how many rows."""
    raw = raw_orders(spark, sf)
    labelled = label(raw, RAW_RULES)
    added = added_columns(raw, labelled)
    counts = labelled.agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.explode(F.array(*[F.lit(c) for c in added])).alias("added"), "rows")
