"""Behavioural checks: change an input, score again, compare the two scores of the same row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Score = Callable[[DataFrame], DataFrame]

# How far a score may fall by rounding, and the plausible range of an estimate.
TOLERANCE = 0.01
PLAUSIBLE = (3.0, 240.0)


def score_twice(
    rows: DataFrame, score: Score, change: dict[str, Column], baseline: dict[str, Column] | None = None
) -> DataFrame:
    """``pred_a`` on the rows as they are (or after ``baseline``), ``pred_b`` after ``change``.

    ``score`` adds a column ``pred`` and keeps the columns it was given. Both scores end up on
    one row, so nothing is joined.
    """
    columns = rows.columns
    saved = {f"_was_{c}": F.col(c) for c in {**change, **(baseline or {})} if c in columns}
    first = score(rows.withColumns(saved).withColumns(baseline or {}))
    first = first.select(*columns, *saved, F.col("pred").alias("pred_a"))
    original = first.withColumns({name[5:]: F.col(name) for name in saved})
    second = score(original.withColumns(change))
    restored = second.withColumns({name[5:]: F.col(name) for name in saved})
    return restored.select(*columns, "pred_a", F.col("pred").alias("pred_b"))


def never_lower(scored: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows whose score fell although the change should raise it."""
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("pred_b") < F.col("pred_a") - tolerance).alias("violations"),
    )


def unchanged(scored: DataFrame, relative: float = 1e-5, absolute: float = 1e-8) -> DataFrame:
    """Rows whose score moved although nothing relevant changed."""
    moved = F.abs(F.col("pred_a") - F.col("pred_b")) > absolute + relative * F.abs(F.col("pred_b"))
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(moved).alias("violations"))


def implausible(scored: DataFrame, pred: str = "pred", band: tuple[float, float] = PLAUSIBLE) -> DataFrame:
    outside = ~F.coalesce(F.col(pred).between(*band), F.lit(False))
    return scored.agg(F.count(F.lit(1)).alias("rows"), F.count_if(outside).alias("violations"))


def shift_report(scored: DataFrame, by: str, max_ratio: float = 1.5) -> DataFrame:
    """How far two scores of the same rows lie apart per group, and whether the groups still differ.

    ``spread_*`` is the standard deviation of the group means: after a unit change all groups
    get much the same answer and it shrinks.
    """
    groups = scored.groupBy(by).agg(F.avg("pred_a").alias("a"), F.avg("pred_b").alias("b"))
    ratio = F.try_divide(F.greatest("a", "b"), F.least("a", "b"))
    return groups.agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(ratio > max_ratio).alias("moved_groups"),
        F.max(ratio).alias("max_ratio"),
        F.stddev_pop("a").alias("spread_before"),
        F.stddev_pop("b").alias("spread_after"),
    )


def recorded_predictions(text: str) -> Column:
    """Every ``eta_minutes`` in a text of recorded responses, in order."""
    found = F.regexp_extract_all(F.col(text), F.lit(r'"eta_minutes":\s*([0-9.]+)'), F.lit(1))
    return F.transform(found, lambda v: v.try_cast("double"))


def prediction_ratio(text: str) -> Column:
    """Largest over smallest ``eta_minutes`` found in a text of recorded responses."""
    values = recorded_predictions(text)
    return F.try_divide(F.array_max(values), F.array_min(values))
