"""What a scoring job reads: one pointer for a version of the feature table and a version of the model.

Tables and models are published on their own, each below its own root, and become visible to scoring by one row
that names both. A reader takes the latest row, so it never pairs a table with a model that was
not released with it. Models are immutable: whoever has loaded one may keep it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from punctual.sources.versions import publish, publish_folder, read_version, version_folder

PAIR = "store_root string, of_store long, store_path string, model_root string, of_model long, model_path string"


@dataclass
class Release:
    """``release`` is the number of the pair; ``features`` are the columns that the model was fitted on."""

    release: int
    store: DataFrame
    store_version: int
    model: PipelineModel
    model_version: int
    features: list[str]


def publish_model(
    model: PipelineModel, root: str, features: list[str], metrics: DataFrame | None = None, origin: str | None = None
) -> int:
    """Save a fitted pipeline with the features it takes and how it did as a new version; its number."""
    spark = SparkSession.getActiveSession()

    def write(path: str) -> None:
        model.write().save(os.path.join(path, "pipeline"))
        lines = spark.range(1) if metrics is None else metrics
        told = F.lit(None).cast("string") if metrics is None else F.to_json(F.struct(*metrics.columns))
        about = lines.select(F.array(*[F.lit(f) for f in features]).cast("array<string>").alias("features"), told.alias("metrics"))
        about.coalesce(1).write.parquet(os.path.join(path, "about"))

    return publish_folder(spark, root, write, origin)


def read_model(spark: SparkSession, root: str, version: int | None = None) -> tuple[PipelineModel, Row]:
    """The given or the latest model, and (features, metrics)."""
    _, path = version_folder(spark, root, version)
    return PipelineModel.load(os.path.join(path, "pipeline")), spark.read.parquet(os.path.join(path, "about")).first()


def release(
    spark: SparkSession, root: str, store_root: str, model_root: str, *, store_version: int | None = None,
    model_version: int | None = None, origin: str | None = None,
) -> int:
    """Announce a pair, by default of the latest versions, and return its number."""
    store, store_path = version_folder(spark, store_root, store_version)
    model, model_path = version_folder(spark, model_root, model_version)
    pair = [(store_root, store, store_path, model_root, model, model_path)]
    return publish(spark.createDataFrame(pair, PAIR).coalesce(1), root, origin)


def released(spark: SparkSession, root: str, loaded: dict[str, tuple[PipelineModel, list[str]]] | None = None) -> Release:
    """The latest pair. Models already in ``loaded`` (by path) are taken from there, new ones are added."""
    pair = read_version(spark, root).first()
    known = {} if loaded is None else loaded
    path = pair["model_path"]
    if path not in known:
        about = spark.read.parquet(os.path.join(path, "about")).first()
        known[path] = PipelineModel.load(os.path.join(path, "pipeline")), list(about["features"])
    model, features = known[path]
    store = spark.read.parquet(pair["store_path"])
    return Release(pair["store_version"], store, pair["of_store"], model, pair["of_model"], features)


def pinned_stores(spark: SparkSession, root: str, store_root: str, keep: int = 10) -> set[int]:
    """Versions of a store that one of the last ``keep`` releases names: ``expire`` must leave them."""
    try:
        last, _ = version_folder(spark, root)
    except FileNotFoundError:
        return set()
    found = set()
    for number in range(max(1, last - keep + 1), last + 1):
        try:
            pair = read_version(spark, root, number).first()
        except FileNotFoundError:
            continue
        if pair["store_root"] == store_root:
            found.add(pair["of_store"])
    return found
