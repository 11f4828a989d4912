"""Error and business measures as aggregate expressions over a row's own prediction and truth.

All of them combine on the map side, so a report over any number of rows shuffles one
small row per task and group.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mae(pred: str, actual: str) -> Column:
    return F.avg(F.abs(F.col(pred) - F.col(actual)))


def bias(pred: str, actual: str) -> Column:
    return F.avg(F.col(pred) - F.col(actual))


def r2(pred: str, actual: str) -> Column:
    """1 - SSE / SST; null where the truth does not vary. (``regr_r2`` is a squared correlation.)"""
    error = F.col(pred) - F.col(actual)
    known = F.when(error.isNotNull(), F.col(actual))
    return 1 - F.try_divide(F.avg(error * error), F.var_pop(known))


def promises_broken(pred: str, actual: str) -> Column:
    """Share of rows whose promise was shorter than reality."""
    return F.avg((F.col(pred) < F.col(actual)).cast("double"))


def idle_minutes(pred: str, actual: str) -> Column:
    """Total minutes waited because the promise was too long; a short promise adds nothing."""
    return F.sum(F.greatest(F.col(pred) - F.col(actual), F.lit(0.0)))


def idle_per_thousand(pred: str, actual: str) -> Column:
    return F.try_divide(idle_minutes(pred, actual) * 1000, F.count(F.col(pred) - F.col(actual)))


def regression_columns(pred: str, actual: str) -> dict[str, Column]:
    return {
        "n": F.count(F.col(pred) - F.col(actual)),
        "mae": mae(pred, actual),
        "bias": bias(pred, actual),
        "r2": r2(pred, actual),
    }


def confusion_columns(hit: Column, positive: Column) -> dict[str, Column]:
    """caught / missed / false alarms / correct rejections for a boolean decision and truth."""
    return {
        "caught": F.count_if(hit & positive),
        "missed": F.count_if(~hit & positive),
        "false_alarms": F.count_if(hit & ~positive),
        "rejected": F.count_if(~hit & ~positive),
    }


def confusion_rates() -> dict[str, Column]:
    """Accuracy, precision and recall from the four counts; an empty denominator counts as 1."""
    caught, missed = F.col("caught"), F.col("missed")
    alarms, rejected = F.col("false_alarms"), F.col("rejected")
    one = F.lit(1)
    return {
        "accuracy": (caught + rejected) / F.greatest(caught + missed + alarms + rejected, one),
        "precision": caught / F.greatest(caught + alarms, one),
        "recall": caught / F.greatest(caught + missed, one),
    }
