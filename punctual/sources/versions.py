"""A table that is replaced as a whole while others read it.

Each version is written to a folder of its own, under a name that no other attempt uses, and becomes
visible by one row in a small pointer table. A reader picks one version and reads only that folder,
so it never sees a mix of two, and nothing it may have open is ever overwritten. Numbers only grow:
whoever publishes next gets the latest number plus one, also after a restart with new progress.
A micro-batch that is run again is known by its origin and publishes nothing. There is one publisher
at a time.

A version may be held back when it is published, and withdrawn later. Both are one more row of the pointer table, the
last row about a version counts, and readers pass over a version that is held or withdrawn: they read the latest
one before it. Nothing is rewritten, and numbers still only grow.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "version long, folder string, origin string, published_at timestamp, state string"
# A row without a state, as written by earlier versions of this module, is live.
LIVE, HELD, WITHDRAWN = "live", "held", "withdrawn"


def _pointer(root: str) -> str:
    return os.path.join(root, "published")


def _versions(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(POINTER).parquet(_pointer(root))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _states(known: DataFrame) -> DataFrame:
    """One row per version: what was said about it last."""
    last = F.max(F.struct("published_at", F.coalesce("state", F.lit(LIVE)).alias("state"), "folder")).alias("r")
    return known.groupBy("version").agg(last).select("version", "r.folder", "r.state", "r.published_at")


def _announce(spark: SparkSession, root: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, POINTER).coalesce(1).write.mode("append").parquet(_pointer(root))


def publish(df: DataFrame, root: str, origin: str | None = None, *, held: bool = False) -> int:
    """Write ``df`` as a new version, announce it (as held back, if so asked) and return its number.

    With an ``origin``, such as a stream's id and batch, that is already announced, nothing is written
    and its number is returned.
    """
    return publish_folder(df.sparkSession, root, lambda path: df.write.option("compression", "zstd").parquet(path), origin, held=held)


def publish_folder(
    spark: SparkSession, root: str, write: Callable[[str], None], origin: str | None = None, *, held: bool = False
) -> int:
    """Like ``publish`` for anything that ``write`` puts into the folder it is given."""
    before = None if origin is None else published_origin(spark, root, origin)
    if before is not None:
        return before
    folder = f"v-{uuid.uuid4().hex}"
    write(os.path.join(root, folder))
    version = (latest_version(spark, root) or 0) + 1
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    _announce(spark, root, [(version, folder, origin, now, HELD if held else LIVE)])
    return version


def _say(spark: SparkSession, root: str, version: int, state: str) -> None:
    known = _versions(spark, root)
    row = None if known is None else _states(known).filter(F.col("version") == version).first()
    if row is None:
        raise FileNotFoundError(f"no version {version} below {root}")
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    _announce(spark, root, [(version, row["folder"], None, now, state)])


def withdraw(spark: SparkSession, root: str, version: int) -> int | None:
    """Take a version back: from now on readers get the latest live one before it, whose number is returned."""
    _say(spark, root, version, WITHDRAWN)
    return live_version(spark, root)


def let_out(spark: SparkSession, root: str, version: int) -> None:
    """Make a version that was held back or withdrawn live."""
    _say(spark, root, version, LIVE)


def live_version(spark: SparkSession, root: str) -> int | None:
    """The version that readers get, if there is one."""
    known = _versions(spark, root)
    return None if known is None else _states(known).filter(F.col("state") == LIVE).agg(F.max("version")).first()[0]


def version_folders(spark: SparkSession, root: str) -> list[str]:
    """Paths of all versions that are announced."""
    known = _versions(spark, root)
    return [] if known is None else [os.path.join(root, r["folder"]) for r in known.select("folder").distinct().collect()]


def published_origin(spark: SparkSession, root: str, origin: str) -> int | None:
    """The version that was published for this origin, if there is one."""
    known = _versions(spark, root)
    return None if known is None else known.filter(F.col("origin") == origin).agg(F.max("version")).first()[0]


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The largest number given so far, live or not."""
    known = _versions(spark, root)
    return None if known is None else known.agg(F.max("version")).first()[0]


def version_folder(spark: SparkSession, root: str, version: int | None = None) -> tuple[int, str]:
    """Number and path of the given version, whatever its state, or of the latest live one."""
    known = _versions(spark, root)
    row = None
    if known is not None:
        wanted = F.col("state") == LIVE if version is None else F.col("version") == version
        row = _states(known).filter(wanted).agg(F.max(F.struct("version", "folder")).alias("r")).first()["r"]
    if row is None:
        raise FileNotFoundError(f"nothing published below {root}")
    return row["version"], os.path.join(root, row["folder"])


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The given or the latest live version, with its number in ``store_version``."""
    number, path = version_folder(spark, root, version)
    return spark.read.parquet(path).withColumn("store_version", F.lit(number))


def expire(
    spark: SparkSession, root: str, keep: int = 10, grace_seconds: float = 3600, pinned: Iterable[int] = ()
) -> int:
    """Make the pointer one file and delete versions that are neither among the last ``keep``, nor ``pinned``, nor
    younger than the grace that readers are given. Returns how many versions went.

    What stays is announced anew before anything is deleted, so a reader finds the latest version at any time.
    """
    known = _versions(spark, root)
    if known is None:
        return 0
    files = [r["f"] for r in known.select(F.col("_metadata.file_path").alias("f")).distinct().collect()]
    # a few rows per publication since the last call
    rows: dict[int, list[tuple]] = {}
    for r in known.collect():
        rows.setdefault(r["version"], []).append(tuple(r))
    live = {r["version"] for r in _states(known).filter(F.col("state") == LIVE).select("version").collect()}
    last = {*sorted(rows)[-keep:], *sorted(live)[-keep:], *pinned}
    oldest = time.time() - grace_seconds
    kept = {v: r for v, r in rows.items() if v in last or max(x[3].timestamp() for x in r) > oldest}
    _announce(spark, root, sorted({x for r in kept.values() for x in r}, key=lambda x: (x[0], x[3])))
    for path in [*files, *{os.path.join(root, x[1]) for v, r in rows.items() if v not in kept for x in r}]:
        delete_folder(spark, path)
    return len(rows) - len(kept)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Through Hadoop's file systems, which reach whatever Spark writes to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
