"""Language identification by the nearest of several centroids per language.

A text is the vector of its character 1-, 2- and 3-grams, hashed to a fixed number of cells, weighted
by log(1 + count) and inverse document frequency and scaled to length 1. The texts of a language are
clustered by cosine; a text gets the language of the centroid it is nearest to. It is rejected if it
is farther from that centroid than texts of its length were in training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import broadcast_if_small, give_back, written

#: Bounds of the model: texts per language that are learned from, cells of a vector, centroids per language.
PER_LANGUAGE, CELLS, CENTROIDS = 1000, 4096, 4
#: Languages whose centroids are held at once. With more, tasks read them from the shared folder block by block.
AT_ONCE = 500
ROUNDS = 12
#: A text is rejected below this share of the similarity that nearly all training texts reached.
SLACK, NEARLY_ALL = 0.5, 0.01
#: Lengths are compared in powers of two; with fewer training texts than this, together with the nearest lengths.
LEAST_TEXTS = 20
TEXTS_AT_ONCE = 256

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def counts(text: str | None, cells: int = CELLS) -> np.ndarray | None:
    """Counts of the n-grams of ``text`` per cell, or None if it has no letter.

    Letters are taken in lower case; whatever lies between two words counts as one blank.
    """
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return None
    keep = is_letter.copy()
    keep[:-1] |= is_letter[1:]  # the last character before a word
    codes = np.where(is_letter, codes, 32)[keep].astype(np.uint32)
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
    three = two[:-1] * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - (cells.bit_length() - 1))
    out = np.bincount(three >> shift, minlength=cells) + np.bincount(two * np.uint32(0x165667B1) >> shift, minlength=cells)
    return out + np.bincount(codes[1:-1] * np.uint32(0x2C1B3C6D) >> shift, minlength=cells)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Block:
    centroids: np.ndarray  # a row each, of length 1
    language: list[str]  # of each centroid
    floor: np.ndarray  # least similarity per centroid's language and power of two of the length

    @classmethod
    def of(cls, made: list[tuple]) -> Block:
        """From (lang, centre, floor) in any order."""
        made = sorted(made, key=lambda r: (r[0], list(r[1])))
        return cls(np.array([r[1] for r in made], np.float32), [r[0] for r in made], np.array([r[2] for r in made]))


@dataclass
class Model:
    """The centroids of up to ``AT_ONCE`` languages are in ``held``, those of more in the Parquet files ``files``,
    each of which has about so many, in the order of the languages."""

    idf: np.ndarray
    held: Block | None
    files: list[str]

    def vectors(self, rows: list[np.ndarray]) -> np.ndarray:
        return unit(np.log1p(np.array(rows, np.float32)) * self.idf)

    def blocks(self) -> Iterator[Block]:
        if self.held:
            yield self.held
        for path in self.files:
            store, inside = fs.FileSystem.from_uri(path)
            read = pq.read_table(inside, filesystem=store).to_pylist()
            if read:
                yield Block.of([(r["lang"], r["centre"], r["floor"]) for r in read])


def length_class(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(n, 1)).astype(int), 31)


def clustered(vectors: np.ndarray, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids by cosine. Starts from the first vector and those least like the ones before."""
    starts = [0]
    while len(starts) < min(k, len(vectors)):
        starts.append(int(np.argmin((vectors @ vectors[starts].T).max(axis=1))))
    centres = vectors[starts]
    for _ in range(rounds):
        near = (vectors @ centres.T).argmax(axis=1)
        sums = np.array([vectors[near == j].sum(axis=0) if (near == j).any() else centres[j] for j in range(len(centres))])
        centres = unit(sums)
    return centres


def floors(near: np.ndarray, long: np.ndarray) -> np.ndarray:
    """The least similarity of each of the 32 length classes, from the similarities of texts of the classes ``long``.

    A class with under ``LEAST_TEXTS`` texts is taken together with the nearest ones up to as many, or all, texts.
    What is longer than the class counts as less similar by the fourth root of the lengths' ratio, as a short part
    of a text shares less with a centroid than the text.
    """
    floor = np.zeros(32)
    for c in range(32):
        away = np.abs(long - c)
        reach = np.sort(away)[min(LEAST_TEXTS, len(away)) - 1]
        like = near * np.minimum(1, 2.0 ** ((c - long) / 4))
        floor[c] = SLACK * np.quantile(like[away <= reach], NEARLY_ALL)
    return floor


def fit(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
    per_language: int = PER_LANGUAGE, cells: int = CELLS, k: int = CENTROIDS,
) -> Model | None:
    """Learn from at most ``per_language`` texts per language, those whose id and text have the least hash.

    Rows without a language or a letter teach nothing; without any other row there is no model. Every
    language is learned, however many there are; the driver holds the centroids of ``AT_ONCE`` languages at most.
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"),
    )
    # from the share of the hash range that holds some four samples; the rest never leaves its task
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("size")), "languages")
    share = F.lit(4.0 * per_language) / F.col("size")
    near = rows.join(broadcast_if_small(sizes, sizes.count()), "lang").where(F.col("h") / 2.0**64 + 0.5 <= share)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = near.drop("size").withColumn("no", first).where(F.col("no") <= per_language)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[start : start + TEXTS_AT_ONCE]
                vectors = [counts(t, cells) for t in part["text"]]
                out = pd.DataFrame({"lang": part["lang"], "no": part["no"], "v": vectors})
                yield out[[v is not None for v in vectors]]
            batch = part = vectors = out = None
        give_back()

    counted = written(sample.mapInPandas(count, "lang string, no int, v array<bigint>"), "language_sample")

    def held(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(group["v"].to_list())
        out = pd.DataFrame({"lang": [group["lang"].iloc[0]], "n": [len(rows)], "df": [(rows > 0).sum(axis=0)]})
        rows = group = None
        give_back()
        return out

    seen = written(counted.groupBy("lang").applyInPandas(held, "lang string, n bigint, df array<bigint>"), "language_counts")
    texts = seen.agg(F.sum("n").alias("n"), F.count("*").alias("languages")).first()
    if not texts["languages"]:
        return None
    df = np.zeros(cells)
    for r in seen.select(F.posexplode("df").alias("cell", "n")).groupBy("cell").agg(F.sum("n").alias("n")).collect():
        df[r["cell"]] = r["n"]
    idf = np.log((1 + texts["n"]) / (1 + df)).astype(np.float32) + 1

    def cluster(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.stack(group.sort_values("no")["v"].to_list())
        vectors = unit(np.log1p(rows.astype(np.float32)) * idf)
        centres = clustered(vectors, k)
        near, long = (vectors @ centres.T).max(axis=1), length_class(rows.sum(axis=1))
        floor = floors(near, long)
        out = pd.DataFrame({"lang": group["lang"].iloc[0], "centre": list(centres), "floor": [floor] * len(centres)})
        rows = vectors = near = group = None
        give_back()
        return out

    made = counted.groupBy("lang").applyInPandas(cluster, "lang string, centre array<float>, floor array<double>")
    if texts["languages"] <= AT_ONCE:
        return Model(idf, Block.of([tuple(r) for r in made.collect()]), [])
    blocks = -(-texts["languages"] // AT_ONCE)
    stored = written(written(made, "centroids").repartitionByRange(blocks, "lang"), "centroid_blocks")
    first = stored.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.min("lang").alias("lang")).orderBy("lang")
    return Model(idf, None, [r["path"] for r in first.collect()])


def predict(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score (the cosine, 0 to 1) and rejected; all other columns stay.

    ``und``, score 0 and rejected without a letter (a null or an empty text) or without a model. A text
    that is too far from its centroid is rejected but keeps the nearest language and its score. Columns
    of ``docs`` with one of the three names are replaced. Texts are taken whole; nothing is shuffled.
    """
    others = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]

    def guess(batches):
        for batch in batches:
            out = pd.DataFrame({"lang_pred": "und", "score": 0.0, "rejected": True}, index=range(len(batch)))
            # vectors of a few texts at a time: one takes as much room as a long text
            best = np.full(len(batch), -np.inf)
            for block in model.blocks() if model else ():
                for start in range(0, len(batch), TEXTS_AT_ONCE):
                    rows = [counts(t, len(model.idf)) for t in batch.iloc[start : start + TEXTS_AT_ONCE]]
                    part = np.array([start + i for i, row in enumerate(rows) if row is not None], int)
                    rows = [row for row in rows if row is not None]
                    if not rows:
                        continue
                    near = model.vectors(rows) @ block.centroids.T
                    own, most = near.argmax(axis=1), near.max(axis=1).astype(float)
                    better = most > best[part]
                    part, own, most = part[better], own[better], most[better]
                    long = length_class(np.array([row.sum() for row in rows]))[better]
                    score = np.clip(most, 0, 1)
                    best[part] = most
                    out.loc[part, "lang_pred"] = [block.language[i] for i in own]
                    out.loc[part, "score"] = score
                    out.loc[part, "rejected"] = score < block.floor[own, long]
            yield out
            batch = out = rows = None
        give_back()

    guess.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    guessed = F.pandas_udf(guess, "lang_pred string, score double, rejected boolean")(F.col(text_col))
    named = docs.select(*[F.col(f"`{c}`") for c in others], guessed.alias("guessed_language"))
    return named.select(*[F.col(f"`{c}`") for c in others], "guessed_language.*")
