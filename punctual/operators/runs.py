"""Run records: settings, scores and the fingerprint of the data, one row per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_record(name: str, params: dict[str, str], data_sha: DataFrame, metrics: DataFrame) -> DataFrame:
    """One run as a row: params and metrics as maps. ``metrics`` has one row of numbers."""
    sha = data_sha.select("data_sha").scalar()
    pairs = [p for k, v in params.items() for p in (F.lit(k), F.lit(str(v)))]
    numbers = [p for c in metrics.columns for p in (F.lit(c), F.col(c).cast("double"))]
    return metrics.select(
        F.lit(name).alias("name"),
        F.map_concat(F.create_map(*pairs), F.create_map(F.lit("data_sha"), sha)).alias("params"),
        F.create_map(*numbers).alias("metrics"),
    )


def latest_runs(runs: DataFrame) -> DataFrame:
    """One row per run name: the one logged last."""
    rank = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("logged_at")))
    return runs.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def leaderboard(runs: DataFrame, metric: str = "mae") -> DataFrame:
    """Runs by ``metric``, best first, with its ratio to the best and the fingerprint beside the score."""
    value = F.col("metrics")[metric]
    best = runs.agg(F.min(value)).scalar()
    return runs.select(
        "name", value.alias(metric), (value / best).alias("x_best"), F.col("params")["data_sha"].alias("data_sha")
    ).orderBy(F.asc_nulls_last(metric), "name")


def same_data(runs: DataFrame, metric: str = "mae") -> DataFrame:
    """Per fingerprint: how many runs share it, and the best and worst of them.

    Only scores within one line were measured on the same data.
    """
    value = F.col("metrics")[metric]
    return runs.groupBy(F.col("params")["data_sha"].alias("data_sha")).agg(
        F.count(F.lit(1)).alias("runs"), F.min(value).alias("best"), F.max(value).alias("worst")
    )


def compare(runs: DataFrame, a: str, b: str) -> DataFrame:
    """Every param and metric of two runs side by side, with whether they agree."""
    fields = F.map_concat(
        "params", F.transform_values("metrics", lambda _, v: v.cast("string"))
    )
    long = runs.filter(F.col("name").isin(a, b)).select("name", F.explode(fields).alias("field", "value"))
    def of(run: str):
        return F.max(F.when(F.col("name") == run, F.col("value")))

    return long.groupBy("field").agg(
        of(a).alias("a"), of(b).alias("b"), of(a).eqNullSafe(of(b)).alias("same")
    )
