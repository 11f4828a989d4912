"""Parsing and normalising raw values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Turn NaN into null, so that averages skip it and comparisons drop it."""
    names = columns or [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(float("nan"))) for c in names})


def parse_ntz(text: str | Column) -> Column:
    """ISO text to a zone-less timestamp; text that is not a timestamp becomes null."""
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("timestamp_ntz")


def utc(instant: Column) -> Column:
    """An instant as a zone-less UTC timestamp, whatever the session zone and its summer time."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit("1970-01-01").cast("timestamp_ntz"))


def parse_utc(text: str | Column) -> Column:
    """ISO text to a zone-less UTC timestamp, honouring an offset in the text if there is one."""
    column = F.col(text) if isinstance(text, str) else text
    moved = utc(column.try_cast("timestamp"))
    has_offset = column.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & column.contains(":")
    return F.when(has_offset, moved).otherwise(column.try_cast("timestamp_ntz"))


def parse_local(text: str | Column) -> Column:
    """ISO text to the zone-less time that it names: an offset in the text is left aside."""
    column = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(column, r"(?<=\d[T ]\d\d:[\d:.]{0,15})(Z|[+-]\d{2}(:?\d{2})?)$", "").try_cast("timestamp_ntz")


def minutes_between(later: Column, earlier: Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``, as minutes."""
    return F.timestamp_diff("SECOND", earlier, later) / F.lit(60.0)


def shift_minutes(ts: Column, minutes: int) -> Column:
    return F.timestamp_add("MINUTE", F.lit(minutes), ts)


def to_number(column: str | Column) -> Column:
    """Text to double; anything that is not a number becomes null."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("double")


def fill_zero(df: DataFrame, columns: list[str], flag: str = "filled") -> DataFrame:
    """Fill null and NaN with 0 and say in ``flag`` how many values of the row were filled."""
    def missing(c: str) -> Column:
        return F.col(c).isNull() | F.isnan(F.col(c).cast("double"))

    count = sum((F.when(missing(c), 1).otherwise(0) for c in columns), F.lit(0))
    filled = {c: F.when(missing(c), F.lit(0)).otherwise(F.col(c)).cast(df.schema[c].dataType) for c in columns}
    return df.withColumn(flag, count).withColumns(filled)
