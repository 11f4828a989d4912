"""Plain descriptions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.operators.quantiles import counted_quantiles
from punctual.session import settle


def summary(df: DataFrame, columns: list[str], *, quartiles: bool = True) -> DataFrame:
    """Per column: rows, nulls, mean, standard deviation, min, max and exact quartiles."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    # the rows are read once, for counts per value; the rest is computed from these
    long = df.select(F.inline(cells))
    counts = settle(long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    known = F.col("value").isNotNull()
    plain = settle(counts.groupBy("column").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("count"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("null_count"),
        F.try_divide(F.sum(F.col("value") * F.col("n")), F.sum(F.when(known, F.col("n")))).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    ))
    off = F.col("value") - F.col("mean")
    spread = counts.join(plain.select("column", "mean", "count"), "column").groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(off * off * F.col("n")), F.max("count") - 1)).alias("std")
    )
    plain = plain.join(spread, "column").select("column", "count", "null_count", "mean", "std", "min", "max")
    if not quartiles:
        return plain
    quantiles = counted_quantiles(counts, ["column"], "value", "n", {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return plain.join(quantiles, "column", "left")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their share of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / total)


def group_mean(df: DataFrame, by: list[str], value: str, where: Column | str | None = None) -> DataFrame:
    """Mean of ``value`` per group over the rows that pass ``where``; both reach the scan."""
    rows = df if where is None else df.filter(where)
    return rows.groupBy(*by).agg(F.avg(value).alias(f"mean_{value}"), F.count(value).alias("rows"))


def month_mean(df: DataFrame, ts: str, value: str) -> DataFrame:
    return group_mean(df.select(F.month(ts).alias("month"), value), ["month"], value)


def side_means(df: DataFrame, side: str, columns: list[str]) -> DataFrame:
    """Mean of each column on each side of a split: one line per column."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    )
    def on(name: str) -> Column:
        return F.avg(F.when(F.col(side) == name, F.col("value")))

    return df.select(side, F.inline(cells)).groupBy("column").agg(
        on("train").alias("train_mean"), on("test").alias("test_mean"), (on("test") - on("train")).alias("shift")
    )


def label_spread(df: DataFrame, label: str) -> DataFrame:
    """Is the target almost constant after filtering?"""
    return df.agg(
        F.count(label).alias("rows"),
        F.stddev_pop(label).alias("std"),
        (F.min(label) == F.max(label)).alias("constant"),
    )


def positive_rate(df: DataFrame, positive: Column) -> DataFrame:
    """Share of positive rows and N in "1 : N" (null if there are none)."""
    return df.agg(F.avg(positive.cast("double")).alias("positive_rate")).withColumn(
        "one_in", F.floor(F.try_divide(F.lit(1.0), F.col("positive_rate")))
    )
