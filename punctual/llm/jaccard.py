"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide.

1. Each text becomes its set of word n-grams, of which a digest and the MinHash bands are written.
   Texts with equal sets are one node from here on.
2. Bands shuffle by their hash. Each node of a shared band is tied to the smallest one there, which is
   one aggregation and one row per node, however many share the band.
3. What is tied together is a candidate group. Its members are compared within tasks, all with all, on
   their full sets. A group too large for one task is cut into blocks, and each pair of blocks
   is a task; sets whose sizes differ too much to reach the threshold never meet. Pairs are not
   emitted: a task gives for each member how many it is linked with, and to which group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import broadcast_if_small, components, give_back, text_or_empty, written

WORDS, THRESHOLD = 5, 0.8
#: The chance that a pair at the threshold shares a band, and how many hashes it may cost.
RECALL, HASHES = 0.9999, 420
#: Members of a block.
BLOCK = 256


def banding(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows with which ``hashes`` still reach the recall."""
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)) if threshold < 1 else 1
        if bands * rows > hashes:
            break
        best = bands, rows
    if best is None:
        raise ValueError(f"{hashes} hashes do not reach a recall of {recall}")
    return best


def grams(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the word n-grams of a text; of all its words if it has fewer; none without a word."""
    parts = (text or "").encode("utf-8", "surrogatepass").split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.array([xxhash.xxh64_intdigest(p) for p in parts], np.uint64)
    n = min(words, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = (out ^ h[k : len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


class Bands:
    """MinHash of a set, as one hash per band."""

    def __init__(self, bands: int, rows: int):
        random = np.random.default_rng(bands * 1000 + rows)
        self.shape = bands, rows
        self.a = random.integers(0, 2**31, (2, bands * rows), np.uint32) * np.uint32(2) + np.uint32(1)
        self.mix = random.integers(0, 2**63, (bands, rows), np.uint64) * np.uint64(2) + np.uint64(1)

    def of(self, grams: np.ndarray) -> np.ndarray:
        low, high = grams.astype(np.uint32), (grams >> np.uint64(32)).astype(np.uint32)
        least = np.full(self.a.shape[1], 2**32 - 1, np.uint32)
        for k in range(0, len(grams), 1024):
            part = np.multiply.outer(low[k : k + 1024], self.a[0])
            part ^= np.multiply.outer(high[k : k + 1024], self.a[1])
            np.minimum(least, part.min(axis=0), out=least)
        rows = least.reshape(self.shape).astype(np.uint64) * self.mix
        return (rows.sum(axis=1, dtype=np.uint64) ^ (self.mix[:, 0] >> np.uint64(7))).view(np.int64)


def row_key(id_col: str, text_col: str) -> Column:
    """What a row is found again by in a second reading of the table."""
    return F.unhex(F.md5(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_or_empty(text_col)).cast("binary")))


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int) -> DataFrame:
    """(no, id, key, n, digest, bands) of every row, written. Texts without a word have n = 0."""

    def sign(batches):
        own = Bands(bands, rows)
        for batch in batches:
            out = []
            for text in batch:
                g = grams(text, words)
                out.append((len(g), hashlib.blake2b(g.tobytes(), digest_size=16).digest(), own.of(g) if len(g) else []))
            yield pd.DataFrame(out, columns=["n", "digest", "bands"])
            batch = out = None
        give_back()

    sign.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    signed = F.pandas_udf(sign, "n int, digest binary, bands array<bigint>")(F.col(text_col))
    rows_ = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), signed.alias("s"))
    return written(rows_.select(F.monotonically_increasing_id().alias("no"), "id", "key", "s.*"), "signatures")


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: Fraction) -> np.ndarray:
    """Which pairs of ``left`` x ``right`` (positions in ``sets``) reach the threshold."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    column = np.cumsum(counts > 1) - 1
    owner, at = owner[shared], column[inverse[shared]]
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    both = np.zeros((len(left), len(right)), np.float32)
    spot = np.full((2, len(sets)), -1)
    spot[0, left], spot[1, right] = np.arange(len(left)), np.arange(len(right))
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, 8192):
        a, b = np.searchsorted(at, [start, start + 8192])
        own, col = owner[a:b], at[a:b] - start
        x, y = np.zeros((len(left), 8192), np.float32), np.zeros((len(right), 8192), np.float32)
        for m, side in ((x, spot[0]), (y, spot[1])):
            inside = side[own] >= 0
            m[side[own][inside], col[inside]] = 1
        both += x @ y.T
    inter = both.astype(np.int64)
    union = sizes[left][:, None] + sizes[right][None, :] - inter
    return (inter * threshold.denominator >= union * threshold.numerator) & (inter > 0)


def _compare(group: pd.DataFrame, words: int, threshold: Fraction) -> pd.DataFrame:
    """(node, links, root) of the members of one block pair that are linked with another."""
    group = group.drop_duplicates("node")
    nodes, copies = group["node"].to_numpy(), group["copies"].to_numpy()
    sets = [grams(t, words) for t in group["text"]]
    left, right = np.flatnonzero(group["left"]), np.flatnonzero(group["right"])
    if not len(left) or not len(right) or len(nodes) < 2:
        return pd.DataFrame({"node": [], "links": [], "root": []})
    met = linked(sets, left, right, threshold)
    met &= left[:, None] != right[None, :]
    same = len(left) == len(right) and (left == right).all()
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, left, met @ copies[right])
    if not same:
        np.add.at(links, right, met.T @ copies[left])
    root = np.arange(len(nodes))
    for i, j in zip(*np.nonzero(met), strict=True):
        a, b = left[i], right[j]
        while root[a] != a:
            root[a] = a = root[root[a]]
        while root[b] != b:
            root[b] = b = root[root[b]]
        if nodes[a] < nodes[b]:
            root[b] = a
        else:
            root[a] = b
    ends = []
    for a in range(len(nodes)):
        while root[a] != a:
            a = root[a]
        ends.append(a)
    out = pd.DataFrame({"node": nodes, "links": links, "root": nodes[ends]})
    return out[out["links"] > 0]


def _blocks(members: DataFrame, threshold: float, block: int) -> DataFrame:
    """``members`` (root, node, n, ...) once for each task that they take part in: task, left, right."""
    sizes = members.groupBy("root").agg(F.count("*").alias("m"))
    members = members.join(sizes, "root")
    small = members.where(F.col("m") <= block).select(
        "*", F.concat_ws(":", "root").alias("task"), F.lit(True).alias("left"), F.lit(True).alias("right")
    )
    # sets that reach the threshold differ by one class of size at most
    large = members.where(F.col("m") > block).withColumn("c", F.floor(F.log("n") / math.log(1 / threshold) + 1e-9))
    cells = large.groupBy("root", "c").agg(F.ceil(F.count("*") / block).cast("int").alias("k"))
    cells = written(cells, "blocks")
    for name, step in (("here", 0), ("above", 1), ("below", -1)):
        near = cells.select(F.col("root").alias("r"), (F.col("c") - step).alias("d"), F.col("k").alias(name))
        large = large.join(near, (F.col("root") == F.col("r")) & (F.col("c") == F.col("d")), "left").drop("r", "d")
    large = large.withColumn("i", F.pmod(F.xxhash64("node"), F.col("here")).cast("int"))
    task = F.expr(
        "flatten(array("
        " transform(sequence(0, here - 1), j -> named_struct('task', concat_ws(':', root, c, c, least(i, j), greatest(i, j)), 'left', i <= j, 'right', i >= j)),"
        " if(above is null, array(), transform(sequence(0, above - 1), j -> named_struct('task', concat_ws(':', root, c, c + 1, i, j), 'left', true, 'right', false))),"
        " if(below is null, array(), transform(sequence(0, below - 1), j -> named_struct('task', concat_ws(':', root, c - 1, c, j, i), 'left', false, 'right', true)))))"
    )
    large = large.withColumn("t", F.explode(task)).select(*members.columns, "t.task", "t.left", "t.right")
    return small.select(*members.columns, "task", "left", "right").unionByName(large)


def _labels(
    docs: DataFrame, id_col: str, text_col: str, words: int, threshold: float, recall: float, hashes: int, block: int
) -> tuple[DataFrame, DataFrame]:
    """The signatures, and (digest, class_id, n_links, copies) of the sets that are not alone."""
    signed = signatures(docs, id_col, text_col, words, *banding(threshold, recall, hashes))
    some = signed.where("n > 0")
    sets = some.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "no")).alias("first"), F.count("*").alias("copies")
    )
    sets = written(sets.select("digest", "first", F.col("first.no").alias("node"), "copies"), "equal_sets")
    nodes = some.drop("digest").join(sets, F.col("no") == F.col("node")).select("node", "copies", "n", "key", "bands")
    banded = written(nodes, "nodes")
    keys = banded.select("node", F.explode("bands").alias("band"))
    shared = keys.groupBy("band").agg(F.min("node").alias("least"), F.count("*").alias("m")).where("m > 1")
    shared = written(shared.select("band", "least"), "shared_bands")
    # shared bands grow with the input: joined by shuffle at any size, which Spark splits where one is hot
    ties = keys.join(shared, "band").where("node <> least")
    groups = components(ties.select(F.col("node").alias("a"), F.col("least").alias("b")), "candidates")
    members = written(banded.drop("bands").join(groups, "node"), "members")
    tasks = written(_blocks(members.drop("key"), threshold, block).join(members.select("node", "key"), "node"), "tasks")
    texts = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    known = members.select("key").distinct()
    found = texts.join(broadcast_if_small(known, members.count()), "key", "left_semi")
    rows = tasks.join(found, "key").select("task", "node", "copies", "left", "right", "text")
    limit = Fraction(str(threshold))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out, large = _compare(group, words, limit), len(group) >= BLOCK // 2
        group = None
        if large:
            give_back()
        return out

    compared = rows.groupBy("task").applyInPandas(compare, "node bigint, links bigint, root bigint")
    compared = written(compared, "links")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(compared.select(F.col("node").alias("a"), F.col("root").alias("b")), "classes")
    labelled = (
        sets.join(links, "node", "left").join(joined, "node", "left")
        .where("copies > 1 or links is not null")
        .withColumn("root", F.coalesce("root", "node"))
    )
    labelled = written(labelled, "labelled_sets")
    smallest = labelled.groupBy("root").agg(F.min("first").alias("smallest"))
    return signed, labelled.join(smallest, "root").select(
        "digest", F.col("smallest.id").alias("class_id"), F.col("smallest.no").alias("class_no"), "copies",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )


def joined(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
    recall: float = RECALL, hashes: int = HASHES, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: id, class_id, n_links, n_grams, copies, kept, key.

    Two documents are linked if the Jaccard similarity of their sets of word n-grams is at least
    ``threshold``. n_links counts the other documents that one is linked with, copies included; a class
    is what links connect, class_id its smallest id (null last), and the row with it is the one
    kept. copies counts the documents with the same set. A text of fewer words than n has one gram, all
    of its words. A text without a word, null or empty, has no gram and no link: it is a class of its own.
    Repeated rows are documents of their own. Other columns are ignored.
    """
    signed, labels = _labels(docs, id_col, text_col, words, threshold, recall, hashes, block)
    labels = written(labels, "labels")
    out = signed.drop("bands").join(broadcast_if_small(labels, labels.count()), "digest", "left")
    alone = F.col("class_no").isNull()
    return out.select(
        "id", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.col("n").cast("long").alias("n_grams"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("copies"),
        (alone | (F.col("class_no") == F.col("no"))).alias("kept"), "key",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rules) -> DataFrame:
    """The rows of ``docs`` that ``joined`` keeps, with all their columns.

    Only keys of dropped rows are joined with the texts. Rows that share id and text have one key: if it
    is kept, one of them is.
    """
    decided = joined(docs, id_col, text_col, **rules)
    keys = decided.groupBy("key").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"), F.min("n_grams").alias("n"))
    touched = written(keys.where("not kept or (rows > 1 and n > 0)").select("key", "kept"), "dropped")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), row_key(id_col, text_col).alias("key"))
    met = packed.join(broadcast_if_small(touched, touched.count()), "key", "left")
    twins = met.where("kept").dropDuplicates(["key"])
    return met.where("kept is null").select("row").unionByName(twins.select("row")).select("row.*")
