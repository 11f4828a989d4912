"""Splits that do not let a model see the future."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cut_time(df: DataFrame, ts: str, holdout_days: int = 45) -> Column:
    """The latest time minus the holdout, as a one-value subquery."""
    latest = F.max(ts) - F.make_dt_interval(F.lit(holdout_days))
    return df.agg(latest.alias("cut")).scalar()


def time_split(df: DataFrame, ts: str = "placed_utc", holdout_days: int = 45) -> tuple[DataFrame, DataFrame]:
    """Train strictly before the cut, test from the cut on. The cut reaches the scan as a filter."""
    cut = cut_time(df, ts, holdout_days)
    return df.filter(F.col(ts) < cut), df.filter(F.col(ts) >= cut)


def with_side(df: DataFrame, ts: str = "placed_utc", holdout_days: int = 45, name: str = "side") -> DataFrame:
    """The same split as a column, for reports that need both sides in one pass."""
    cut = cut_time(df, ts, holdout_days)
    return df.withColumn(name, F.when(F.col(ts) < cut, "train").when(F.col(ts) >= cut, "test"))


def hash_side(df: DataFrame, row_id: str, seed: int = 2026, train_percent: int = 80) -> DataFrame:
    """Near ``train_percent`` / rest by a hash of the id that other engines have too: no shuffle, no count, repeatable."""
    digest = F.md5(F.concat(F.lit(str(seed)), F.col(row_id).cast("string")).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("side", F.when(bucket < train_percent, "train").otherwise("test"))
