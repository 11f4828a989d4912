"""A user's function over groups, fed with a group's rows batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

GroupFunction = Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def map_groups(df: DataFrame, keys: list[str], function: GroupFunction, schema: StructType | str) -> DataFrame:
    """``function(key, batches)`` for every group of ``df``; it yields frames of ``schema``.

    Rows come as an iterator of Arrow batches (of ``spark.sql.execution.arrow.maxRecordsPerBatch`` rows at most),
    so a task holds one batch of a group and what the function keeps, however large the group is. Rows
    of a group come in no particular order. A null key is a group. What can be said with aggregates and windows
    should be: they need no Python and split a large group over tasks, which this does not.
    """

    def run(key, batches):
        yield from function(key, batches)

    run.__annotations__ = {"key": tuple, "batches": Iterator[pd.DataFrame], "return": Iterator[pd.DataFrame]}
    return df.groupBy(*keys).applyInPandas(run, schema)
