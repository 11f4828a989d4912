"""Errors by named slice and by period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.calendar import is_night, is_peak, is_weekend
from punctual.functions.scores import bias, mae

# Day of the year from which orders were batched (days counted from 1), the
# smallest slice worth a line, and how much worse than overall a slice may be.
SHIFT_DOY = 275
MIN_ROWS = 100
BUDGET = 1.25


def order_slices() -> dict[str, Column]:
    """The named predicates of the order data. They overlap. Names and order."""
    return {
        "night 21:00-09:00": is_night(),
        "peak 12/13/19/20": is_peak(),
        "clear": F.col("weather") == "clear",
        "rain": F.col("weather") == "rain",
        "heavy rain": F.col("weather") == "heavy_rain",
        "short trips < 2 km": F.col("distance_km") < 2,
        "long trips > 10 km": F.col("distance_km") > 10,
        "weekend": is_weekend(),
        "Pune": F.col("city") == "Pune",
        "Mumbai": F.col("city") == "Mumbai",
    }


def slice_report(
    scored: DataFrame, slices: dict[str, Column], pred: str, actual: str, *, min_rows: int = MIN_ROWS
) -> DataFrame:
    """Rows, MAE, MAE relative to all rows and bias per slice, worst first.

    All slices are conditional aggregates of one pass: a row is read once however many slices
    it is in, and every task sends a single row to the shuffle.
    """
    error = F.col(pred) - F.col(actual)
    measures = [F.avg(F.abs(error)).alias("overall")]
    for i, condition in enumerate(slices.values()):
        inside = F.when(condition, error)
        measures += [
            F.count_if(condition).alias(f"n{i}"),
            F.avg(F.abs(inside)).alias(f"m{i}"),
            F.avg(inside).alias(f"b{i}"),
        ]
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("slice"),
                F.col(f"n{i}").alias("rows"),
                F.col(f"m{i}").alias("mae"),
                F.try_divide(F.col(f"m{i}"), F.col("overall")).alias("vs_overall"),
                F.col(f"b{i}").alias("bias"),
            )
            for i, name in enumerate(slices)
        ]
    )
    report = scored.agg(*measures).select(F.inline(lines))
    return report.filter(F.col("rows") >= min_rows).orderBy(F.desc("vs_overall"), "slice")


def worst_slice(report: DataFrame) -> DataFrame:
    return report.orderBy(F.desc("vs_overall"), "slice").limit(1)


def over_budget(report: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Slices whose MAE exceeds ``budget`` times the overall MAE."""
    return report.filter(F.col("vs_overall") > budget)


def period_report(scored: DataFrame, period: Column, pred: str, actual: str) -> DataFrame:
    """Mean truth, mean prediction and bias per period: a regime shift is a bias that stays."""
    return scored.groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(actual).alias("mean_actual"),
        F.avg(pred).alias("mean_predicted"),
        bias(pred, actual).alias("bias"),
    )


def shift_period(doy: str = "doy", held_out: Column | None = None) -> Column:
    """before / after the shift, and the held-out future where that is given."""
    known = F.when(F.col(doy) < SHIFT_DOY, "before").otherwise("after")
    return known if held_out is None else F.when(held_out, "held_out").otherwise(known)


def group_errors(scored: DataFrame, by: list[str], pred: str, actual: str) -> DataFrame:
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), mae(pred, actual).alias("mae"), bias(pred, actual).alias("bias")
    )
