"""Training ranges of features, and scoring inputs that fall outside them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Checked feature -> the training column its range is read from.
ORDER_RANGES = {
    "distance_km": "distance_km",
    "prep_min_estimate": "restaurant_prep_min_estimate",
    "courier_rating": "courier_rating",
}


def training_ranges(train: DataFrame, columns: dict[str, str]) -> DataFrame:
    """feature, lo, hi: the smallest and largest training value of each feature, in one pass."""
    bounds = train.agg(
        *[F.min(c).cast("double").alias(f"lo_{n}") for n, c in columns.items()],
        *[F.max(c).cast("double").alias(f"hi_{n}") for n, c in columns.items()],
    )
    lines = [
        F.struct(F.lit(n).alias("feature"), F.col(f"lo_{n}").alias("lo"), F.col(f"hi_{n}").alias("hi"))
        for n in columns
    ]
    return bounds.select(F.inline(F.array(*lines)))


def with_outside(rows: DataFrame, ranges: DataFrame, name: str = "outside") -> DataFrame:
    """Add the list of features whose value lies outside its (inclusive) training range.

    ``ranges`` has one line per feature, so its values become literals of the plan.
    A null value is not outside.
    """
    checks: list[Column] = [
        F.when(~F.col(r["feature"]).between(r["lo"], r["hi"]), F.lit(r["feature"])) for r in ranges.collect()
    ]
    return rows.withColumn(name, F.array_compact(F.array(*checks)))


def outside_counts(rows: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per feature: range, rows checked and rows outside."""
    bounds = ranges.collect()
    counted = rows.agg(
        *[F.count(b["feature"]).alias(f"n_{b['feature']}") for b in bounds],
        *[
            F.count_if(~F.col(b["feature"]).between(b["lo"], b["hi"])).alias(f"out_{b['feature']}")
            for b in bounds
        ],
    )
    lines = [
        F.struct(
            F.lit(b["feature"]).alias("feature"),
            F.lit(b["lo"]).alias("lo"),
            F.lit(b["hi"]).alias("hi"),
            F.col(f"n_{b['feature']}").alias("rows"),
            F.col(f"out_{b['feature']}").alias("outside"),
        )
        for b in bounds
    ]
    return counted.select(F.inline(F.array(*lines)))
