"""What several corpus operators share: tables in the shared folder, ranks, connected components."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.session import shared_path

#: What counts as white space between words, as a character class of regular expressions.
BLANKS = r"\x20\x09-\x0D"

#: A table may be broadcast up to this measured number of rows; beyond it, joins shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, so that readers and retries start from there."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Return to the system what the batches of a task took, called at its end.

    Spark keeps a Python worker for the tasks of all later stages, and with it the most memory that any of them
    needed, beside the JVM of its executor.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not the GNU library


def broadcast_if_small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast of narrow rows when their measured number allows it."""
    return F.broadcast(df) if rows <= limit else df


def text_or_empty(text: str | Column) -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ranked(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its 1-based rank in the given order, without a sort in one task.

    Ranges of the order are numbered on their own; a range starts after the rows of the ranges
    before it. Only one count per range reaches the driver.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = written(df.repartitionByRange(ranges, *order).withColumn("range_no", F.spark_partition_id()), name)
    sizes = {r["range_no"]: r["n"] for r in cut.groupBy("range_no").agg(F.count("*").alias("n")).collect()}
    starts, seen = [], 0
    for no in sorted(sizes):
        starts.append((no, seen))
        seen += sizes[no]
    begin = F.lit(0).cast("long")
    for no, start in starts:
        begin = F.when(F.col("range_no") == no, F.lit(start).cast("long")).otherwise(begin)
    own = F.row_number().over(Window.partitionBy("range_no").orderBy(*order))
    return cut.withColumn("rank", own + begin).drop("range_no")


def join_counted(rows: DataFrame, lookup: DataFrame, key: str, times: str, total: int, how: str = "left") -> DataFrame:
    """``rows`` joined with ``lookup``, which has one row per key and in ``times`` how many rows have it at least.

    A key with more than a thousandth of all ``total`` rows is one of a thousand at most: these lines of ``lookup`` are
    broadcast, so that the rows of a hot key stay where they are. The others are joined as Spark sees fit.
    Both tables are read twice and should be written.
    """
    hot = F.broadcast(lookup.where(F.col(times) > total / 1000))
    some = rows.join(hot, key).select(*rows.columns, *[c for c in lookup.columns if c != key])
    rest = rows.join(hot.select(key), key, "left_anti").join(lookup.where(F.col(times) <= total / 1000), key, how)
    return some.unionByName(rest.select(*some.columns))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """The smallest node that each node of ``edges`` (a, b) is connected with: (node, root).

    Alternates two steps that hang neighbours below smaller nodes until only stars remain. A step
    is one aggregation and one join on a node: a hub is pre-aggregated, and its neighbours stay where they are.
    Nodes without an edge to another node are left out.
    """
    now = written(_falling(edges), name)
    before = None
    while (state := _state(now)) != before:
        before = state
        ends = 2 * before[0]
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), "a").alias("m"), F.count("*").alias("n"))
        above = join_counted(both.where("b > a"), written(least, f"{name}_least"), "a", "n", ends, "inner")
        hung = written(above.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct(), f"{name}_hung")
        least = written(hung.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")), f"{name}_lowest")
        met = join_counted(hung, least, "a", "n", ends, "inner")
        now = written(
            least.select("a", F.col("m").alias("b"))
            .unionByName(met.where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b")))
            .distinct(),
            name,
        )
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _falling(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
