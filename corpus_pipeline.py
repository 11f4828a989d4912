"""From raw documents to tokens: five stages, each over all that the one before has kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. It is written as Parquet and read again
as the next one's input, so a stage starts from a table and not from a chain of plans. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.llm import bpe, dedup, jaccard, langid, mixing
from punctual.llm.common import table, written
from punctual.llm.queries import held_out


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the documents that are not held out; those without a recognised language go."""
    model = langid.fit(docs.where(~held_out()))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    return langid.predict(packed, model).where("not rejected").select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id stays."""
    return dedup.drop_copies(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of 0.8 or more on 5-word n-grams connect, the smallest id stays."""
    return jaccard.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: some not at all, some twice."""
    return mixing.mixed(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: doc_id, lang, source, n_tokens, ids_sha256, decoded_sha256."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    packed = docs.select(F.struct("doc_id", "lang", "source").alias("row"), "text")
    coded = bpe.coded(packed, ranks, public_tokenizers.PATTERN, id_col="row")
    return coded.select(F.col("id.*"), "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("jaccard_join", jaccard_join),
    ("source_mix", source_mix),
    ("byte_bpe", byte_bpe),
]

#: Clustered centroids and byte pair merges have no SQL; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
