"""Twin records: the same event written twice under different ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.operators.lookup import attach


def keep_first(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """One row per natural key: the first by ``order``, which must not tie.

    A rank filter with a constant bound lets Spark cut every key to one row per task before
    the shuffle, so a key with very many copies sends one row per task, not all of them.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def duplicate_counts(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, distinct natural keys and surplus copies, as one row."""
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("surplus"),
        F.coalesce(F.max("copies"), F.lit(0)).alias("largest_group"),
    )


def split_overlap(df: DataFrame, key: list[str], in_train: Column) -> DataFrame:
    """How far the two sides of a split share natural keys: one row of counts."""
    sides = df.groupBy(*key).agg(
        F.count_if(in_train).alias("train"), F.count_if(~in_train).alias("test")
    )
    both = (F.col("train") > 0) & (F.col("test") > 0)
    return sides.agg(
        F.count_if(both).alias("shared_keys"),
        F.sum(F.when(both, F.col("test")).otherwise(0)).alias("test_rows_seen_in_train"),
        F.sum("test").alias("test_rows"),
    )


def rows_seen_in(rows: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``rows`` whose natural key also occurs in ``other``."""
    return attach(rows, other.select(*key).distinct(), key, "left_semi")
