"""Calendar parts and the named hour predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours of the day that count as night and as peak, first weekend day (Monday = 1).
NIGHT_FROM, NIGHT_UNTIL = 21, 9
PEAK_HOURS = (12, 13, 19, 20)
WEEKEND_FROM = 6


def calendar(ts: str) -> dict[str, Column]:
    """hour 0-23, ISO weekday with Monday = 1, day of the year."""
    return {"hour": F.hour(ts), "dow": iso_weekday(ts), "doy": F.dayofyear(ts)}


def iso_weekday(ts: str) -> Column:
    return F.weekday(ts) + 1


def is_night(hour: str = "hour") -> Column:
    return (F.col(hour) >= NIGHT_FROM) | (F.col(hour) < NIGHT_UNTIL)


def is_peak(hour: str = "hour") -> Column:
    return F.col(hour).isin(*PEAK_HOURS)


def is_weekend(dow: str = "dow") -> Column:
    return F.col(dow) >= WEEKEND_FROM
