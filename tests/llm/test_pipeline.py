"""Each stage of the pipeline against brute force on its own input, and the whole against its stages."""

from collections import Counter

import public_tokenizers as public
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from corpus import docs
from punctual.llm import bpe, langid, mixing
from punctual.llm.queries import held_out
from test_dedup_mixing import flat
from test_similar_and_repeated import brute_joined


def test_stages(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    df = documents
    for name, stage in pipeline.STAGES:
        before, df = df, stage(spark, df, sf)
        df = spark.createDataFrame(df.collect(), df.schema)
        kept[name] = before.collect(), df.collect()
        assert df.columns == documents.columns or name == "byte_bpe"

    before, after = kept["language_id"]
    model = langid.fit(documents.where(~held_out()))
    good = langid.predict(documents, model).where("not rejected").count()
    assert len(after) == good >= 0.98 * len(before)

    before, after = kept["exact_dedup"]
    least = {}
    for r in before:
        least[flat(r["text"])] = min(least.get(flat(r["text"]), r["doc_id"]), r["doc_id"])
    assert Counter(r["doc_id"] for r in after) == Counter(least.values())

    before, after = kept["jaccard_join"]
    classes, n = brute_joined([(r["doc_id"], r["text"]) for r in before])
    assert {r["doc_id"] for r in after} == {c for _, c, _ in classes} and len(after) == n

    before, after = kept["source_mix"]
    plan = mixing.mix_plan(spark.createDataFrame(before, documents.schema)).collect()
    assert Counter(r["doc_id"] for r in after) == Counter({r["id"]: r["copies"] for r in plan if r["copies"]})

    before, after = kept["byte_bpe"]
    own = bpe.Codec(public.path("byte_bpe_50k.tiktoken"), public.PATTERN)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in after) == Counter(
        (r["doc_id"], len(ids.split())) for r, ids in zip(before, own.encode([r["text"] or "" for r in before]), strict=True)
    )
    whole = pipeline.run(spark, sf)
    assert Counter(map(tuple, whole.collect())) == Counter(map(tuple, after))


def test_stages_take_nulls_and_empty_tables(spark, sf):
    rows = [(1, None, "en", "a"), (2, "", None, None), (None, "the of and that", "en", None), (3, "the of and that", "en", "a")] * 2
    for rows_ in (rows, []):
        df = docs(spark, rows_, clashing=False).withColumn("n_chars", F.length("text").cast("long"))
        for name, stage in pipeline.STAGES:
            out = stage(spark, df, sf)
            assert out.count() <= 2 * len(rows_), name
