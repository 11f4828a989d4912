"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


# Whether ``settle`` keeps where columns come from, and the name of that in their metadata.
KEEP_LINEAGE = "punctual.lineage.kept"
SOURCES = "sources"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench. A cluster brings its own session instead."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("punctual")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a missing
    setting is an error, because a machine-local path would vanish with its executor.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="punctual-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, empty path below the shared folder."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and cut its lineage.

    Used for small or reduced intermediate results that are read more than once, so that
    neither a second reader nor a lost executor makes Spark recompute what lies below.
    """
    shared_root(df.sparkSession)
    if df.sparkSession.conf.get(KEEP_LINEAGE, "false") == "true":
        from punctual.operators.lineage import carried

        df = carried(df)
    return df.checkpoint(eager=True)


def settle_observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """Like ``settle``, and the given aggregates of ``df``, taken while it is being written."""
    seen = Observation()
    settled = settle(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]))
    return settled, seen.get
