"""Features learned from the past: fitted on train rows only, applied to any rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.functions.features import flags, ratio
from punctual.operators.lookup import attach, estimated_bytes, size_metrics
from punctual.session import settle_observed


@dataclass(frozen=True)
class History:
    """Mean of a target per key, as fitted on one table, and the mean for keys it never saw."""

    keys: tuple[str, ...]
    name: str
    table: DataFrame
    fallback: float
    size: int

    def apply(self, rows: DataFrame) -> DataFrame:
        rows = rows.drop(self.name)
        joined = attach(rows, self.table.select(*self.keys, self.name), list(self.keys), size=self.size)
        return joined.withColumn(self.name, F.coalesce(F.col(self.name), F.lit(self.fallback)))


def fit_history(train: DataFrame, keys: list[str], target: str, name: str) -> History:
    """One grouped pass over ``train``; the table is written once and shared by every use."""
    sums = train.groupBy(*keys).agg(
        F.avg(target).alias(name), F.sum(target).alias("_total"), F.count(target).alias("_n")
    )
    metrics = {**size_metrics(sums), "total": F.sum("_total"), "n": F.sum("_n")}
    sums, seen = settle_observed(sums, metrics)
    fallback = seen["total"] / seen["n"] if seen["n"] else float("nan")
    return History(tuple(keys), name, sums, fallback, estimated_bytes(sums, seen))


# The histories that the order table is given, by output name.
HISTORIES = {
    "rest_hist_mean": ["restaurant_id"],
    "courier_hist_mean": ["courier_id"],
    "rest_peak_hist_mean": ["restaurant_id", "is_peak"],
}


def build_features(
    train: DataFrame,
    other: DataFrame,
    *,
    target: str = "actual_minutes",
    histories: dict[str, list[str]] | None = None,
    ratios: dict[str, tuple[str, str]] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Add flags, ratios and histories to both tables. Whatever is learned comes from ``train``."""
    plain = {**flags(), **{name: ratio(*pair) for name, pair in (ratios or {}).items()}}
    train, other = train.withColumns(plain), other.withColumns(plain)
    fitted = [
        fit_history(train, keys, target, name)
        for name, keys in (HISTORIES if histories is None else histories).items()
    ]
    for history in fitted:
        train, other = history.apply(train), history.apply(other)
    return train, other


# The ratio features of the order table.
ORDER_RATIOS = {
    "km_per_prep_min": ("distance_km", "restaurant_prep_min_estimate"),
    "price_per_item": ("subtotal_inr", "n_items"),
}
