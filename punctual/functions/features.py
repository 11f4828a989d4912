"""Order-time feature expressions and a fitted-by-hand estimate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from punctual.functions.calendar import is_night, is_peak, is_weekend


def flags(hour: str = "hour", dow: str = "dow") -> dict[str, Column]:
    return {"is_night": is_night(hour), "is_peak": is_peak(hour), "is_weekend": is_weekend(dow)}


def ratio(top: str, bottom: str) -> Column:
    """``top / bottom``; null instead of an error where ``bottom`` is 0 or null."""
    return F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double"))


def additive_rules(base: float, per_unit: dict[str, float], when: list[tuple[Column, float]] = ()) -> Column:
    """Hand-written estimate: a base, so much per unit of some columns, so much where a condition holds.

    A missing amount adds nothing and an unknown condition does not hold, so every row gets a number.
    """
    total = F.lit(float(base))
    for name, weight in per_unit.items():
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(weight))
    for condition, minutes in when:
        total = total + F.when(condition, F.lit(float(minutes))).otherwise(F.lit(0.0))
    return total


def trip_rules() -> Column:
    """Rules for the order table: distance, kitchen time, basket size, weather and busy hours."""
    return additive_rules(
        base=6.0,
        per_unit={"distance_km": 3.0, "restaurant_prep_min_estimate": 0.9, "n_items": 0.4},
        when=[
            (F.col("weather") == "rain", 4.0),
            (F.col("weather") == "heavy_rain", 9.0),
            (is_peak(), 5.0),
        ],
    )
