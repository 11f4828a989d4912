"""A table of queries and the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, together with its SQL where there is one."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Sums of doubles depend on the order of addition; reports show them to ``digits`` decimals."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
