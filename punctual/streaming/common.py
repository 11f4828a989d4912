"""Shared helpers of the streaming jobs."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def file_stream(
    spark: SparkSession, folder: str, schema: StructType | str, *, pattern: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a zoned timestamp; the session zone is UTC, so the instant is kept."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB, which keyed state with timers needs.

    A stream takes the setting when it starts and remembers it in its progress.
    """
    before = spark.conf.get(STATE_PROVIDER, None)
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_PROVIDER)
        else:
            spark.conf.set(STATE_PROVIDER, before)


def drain(df: DataFrame, out: str, *, mode: str = "append") -> StreamingQuery:
    """Write everything there is to read to Parquet below ``out`` and stop."""
    query = (
        df.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", os.path.join(out, "rows"))
        .option("checkpointLocation", os.path.join(out, "progress"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drained(spark: SparkSession, out: str, schema: StructType | str) -> DataFrame:
    """What ``drain`` wrote; with the schema given, also when it wrote nothing."""
    return spark.read.schema(schema).parquet(os.path.join(out, "rows"))


def write_batch(df: DataFrame, root: str, batch_id: int) -> None:
    """One folder per micro-batch: a repeated batch replaces its own output, never doubles it."""
    df.write.mode("overwrite").parquet(os.path.join(root, f"batch={batch_id}"))
