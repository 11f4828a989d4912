"""Ranked lexical search: range-maximum tables over posting lists, best-first over intervals of documents.

1. The index is built where the documents lie. A task cuts its documents into shards of bounded
   size; each term of a shard is one row, its documents in order with the number of occurrences. One
   more row of the shard holds ids and lengths. Texts and postings are not shuffled.
2. For a block of queries, the posting lists of its terms meet the shard they belong to. The impacts
   of a list (what an occurrence adds to a score) go into a sparse table that gives the maximum of any range.
3. A query starts with all documents of the shard as one interval. The sum of its terms' maxima within
   an interval bounds every score there. The intervals with the highest bounds are split first, at the document
   of the largest impact, which is scored exactly; each side gets its own bound. What can not beat the
   documents found so far is dropped, so the result is exact.
4. A share of the shards goes first. The lowest score of their best documents is a bar that holds for all
   others, so these return little more than what is in the result.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punctual.llm.common import written

#: A term is a run of ASCII digits and letters and of all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A shard is closed with so many documents, or with the document that reaches so many postings.
DOCS, POSTINGS = 1 << 14, 1 << 21
#: Queries of a block, and intervals that are split at once.
BLOCK, STEP = 256, 64
#: One shard of so many is searched first.
FIRST = 16
#: Terms of the queries are broadcast up to so many measured bytes; beyond, lists and terms are joined by shuffle.
BROADCAST_BYTES = 64 << 20
FIELD = 16
LAST = (1 << FIELD) - 1
#: Columns of the index after the shard: of its terms, and of the shard itself.
ROWS = ["term", "n", "docs", "times", "total", "ids", "sizes"]
_KEPT = (UPPER + LOWER + "0123456789").encode()
_CHARACTERS = bytes(c if c > 127 else ord(chr(c).lower()) if c in _KEPT else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, with repeats; only A to Z are put in lower case."""
    return text.translate(_CHARACTERS).split()


def query_terms(text: str | Column) -> Column:
    """The different terms of a text as an array; null for a null text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.regexp_extract_all(F.translate(column, UPPER, LOWER), F.lit(TERM), F.lit(0)))


class _Shard:
    """Documents as they come, and the rows of the index that they make."""

    def __init__(self) -> None:
        self.vocabulary = defaultdict(itertools.count().__next__)
        self.ids, self.sizes, self.of, self.times, self.postings = [], [], [], [], 0

    def add(self, id_, text: bytes) -> None:
        found = terms(text)
        if not found:
            return
        counts = Counter(found)
        self.ids.append(id_)
        self.sizes.append(len(found))
        self.of.append(np.fromiter(map(self.vocabulary.__getitem__, counts), np.int64, len(counts)))
        self.times.append(np.fromiter(counts.values(), np.uint32, len(counts)))
        self.postings += len(counts)

    def full(self) -> bool:
        return len(self.ids) >= DOCS or self.postings >= POSTINGS

    def rows(self, shard: int, kind: pa.DataType) -> list[pa.RecordBatch]:
        """A row per term and one for the shard; ``kind`` is the type of the ids."""
        ids = pa.array(self.ids, kind)
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        of, times = np.concatenate(self.of), np.concatenate(self.times)
        docs = np.repeat(place, [len(x) for x in self.of])
        by = np.argsort(of << FIELD | docs)
        ends = np.cumsum(np.bincount(of, minlength=len(self.vocabulary)))
        starts, n = np.concatenate([[0], ends]), len(ends)

        def runs(values: np.ndarray) -> pa.Array:
            offsets = (starts * values.itemsize).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])

        lists = {
            "term": pa.array(list(self.vocabulary), pa.binary()).cast(pa.string()),
            "n": pa.array(np.diff(starts), pa.int64()),
            "docs": runs(docs[by].astype(np.uint16)),
            "times": runs(times[by]),
        }
        sizes = np.array(self.sizes, np.int64)[order]
        about = {
            "n": pa.array([len(ids)], pa.int64()),
            "total": pa.array([int(sizes.sum())], pa.int64()),
            "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))),
            "sizes": pa.array([sizes.tobytes()], pa.binary()),
        }
        kinds = {c: columns[c].type for columns in (lists, about) for c in columns}
        out = []
        for rows, columns in ((n, lists), (1, about)):
            given = [columns.get(c, pa.nulls(rows, kinds[c])) for c in ROWS]
            out.append(pa.record_batch([pa.array(np.full(rows, shard), pa.int64()), *given], names=["shard", *ROWS]))
        return out


@dataclass
class Index:
    """``rows`` (shard, term, n, docs, times, total, ids, sizes), written: a row per term of a shard, and one
    without a term per shard. ``n_docs`` documents have a term, ``n_terms`` with all repeats."""

    rows: DataFrame
    n_docs: int
    n_terms: int


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all whole texts of ``docs``.

    A null text, or one without a term, is not in the index and counts for nothing. Repeated rows are documents
    of their own; an id may be null. Other columns are ignored, whatever their names.
    """
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = given.schema["id"].dataType
    schema = T.StructType().add("shard", "long").add("term", "string").add("n", "long").add("docs", "binary")
    schema = schema.add("times", "binary").add("total", "long").add("ids", T.ArrayType(kind)).add("sizes", "binary")

    def build(batches):
        begin, shard, kind = TaskContext.get().partitionId() << 32, _Shard(), None
        for batch in batches:
            kind = batch["id"].type
            for id_, text in zip(batch["id"], batch["text"], strict=True):
                if text.is_valid:
                    shard.add(id_.as_py(), text.as_buffer().to_pybytes())
                if shard.full():
                    yield from shard.rows(begin, kind)
                    shard, begin = _Shard(), begin + 1
        if shard.ids:
            yield from shard.rows(begin, kind)

    rows = written(given.mapInArrow(build, schema), "postings")
    counts = rows.where("term is null").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).first()
    return Index(rows, counts["n"] or 0, counts["total"] or 0)


class Lists:
    """The posting lists of some terms in one shard, one after the other, with their range-maximum tables.

    An entry of a table is an impact and, below it, how far its document is from the end; so the
    maximum also names the first document that has it.
    """

    def __init__(self, docs: list[bytes], times: list[bytes], sizes: np.ndarray, n_docs: int, n_terms: int):
        lengths = np.array([len(d) // 2 for d in docs], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        doc = np.frombuffer(b"".join(docs), np.uint16).astype(np.int64)
        tf = np.frombuffer(b"".join(times), np.uint32).astype(np.int64)
        # fixed values: the parts of the score that the contract names
        m = 100 - 50 + (50 * sizes * n_docs) // n_terms
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
        self.key = np.repeat(np.arange(len(docs)), lengths) << FIELD | doc
        level = self.impact << FIELD | (LAST - doc)
        levels = [level]
        for k in range(int(lengths.max(initial=1)).bit_length() - 1):
            level = level.copy()
            level[: -(1 << k)] = np.maximum(level[: -(1 << k)], levels[-1][1 << k :])
            levels.append(level)
        self.n = len(doc)
        self.table = np.concatenate(levels)
        self.log = np.zeros(int(lengths.max(initial=1)) + 1, np.int64)
        for k in range(1, len(levels)):
            self.log[1 << k :] = k

    def most(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The largest entries of the ranges from ``a`` up to before ``b``, which lie in one list each; 0 if empty."""
        some = b > a
        k = self.log[b - a]
        row = k * self.n
        found = np.maximum(self.table[np.where(some, row + a, 0)], self.table[np.where(some, row + b - (1 << k), 0)])
        return np.where(some, found, 0)

    def best(self, slots: np.ndarray, weights: np.ndarray, limit: int, bar: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores of the ``limit`` best for a query, equal ones by their order, none
        below ``bar`` or at 0; and how many intervals were split."""
        scores, docs = np.empty(0, np.int64), np.empty(0, np.int64)
        a, b, first = self.starts[slots][None], self.ends[slots][None], np.zeros(1, np.int64)
        top = self.most(a, b)
        bound = ((top >> FIELD) * weights).sum(axis=1)
        split, least = 0, max(bar, 1)
        query = slots << FIELD
        while True:
            keep = bound >= least
            if len(scores) == limit:
                keep &= (bound > scores[-1]) | (first < docs[-1])
            if not keep.any():
                return docs, scores, split
            now = np.flatnonzero(keep)
            if len(now) > STEP:
                now = now[np.argpartition(-bound[now], STEP - 1)[:STEP]]
                keep[now] = False
                rest = keep
            else:
                rest = np.zeros(len(bound), bool)
            split += len(now)
            up, lo, hi = top[now], a[now], b[now]
            by = np.argmax((up >> FIELD) * weights, axis=1)
            x = LAST - (up[np.arange(len(now)), by] & LAST)
            target = query[None] | x[:, None]
            at = np.searchsorted(self.key, target)
            here = (at < hi) & (self.key[np.minimum(at, self.n - 1)] == target)
            exact = (np.where(here, self.impact[np.minimum(at, self.n - 1)], 0) * weights).sum(axis=1)
            scores, docs = np.concatenate([scores, exact]), np.concatenate([docs, x])
            good = np.flatnonzero(scores >= least)
            order = good[np.lexsort((docs[good], -scores[good]))][:limit]
            scores, docs = scores[order], docs[order]
            if len(scores) == limit:
                least = max(least, int(scores[-1]))
            a2, b2 = np.concatenate([lo, at + here]), np.concatenate([at, hi])
            top2 = self.most(a2, b2)
            bound2 = ((top2 >> FIELD) * weights).sum(axis=1)
            good = bound2 >= least
            a, b = np.concatenate([a[rest], a2[good]]), np.concatenate([b[rest], b2[good]])
            top, bound = np.concatenate([top[rest], top2[good]]), np.concatenate([bound[rest], bound2[good]])
            first = np.concatenate([first[rest], np.concatenate([first[now], x + 1])[good]])


def _search(made: Index, lists: DataFrame, bars: DataFrame, shards: Column, blocks: int, limit: int, name: str) -> DataFrame:
    """(query, score, id) of the best of each shard that ``shards`` holds for, at least the bar of its query.

    lists: (block, shard, term, weight, queries, docs, times); bars: (block, bars), a map from query to bar.
    """
    n_docs, n_terms = made.n_docs, made.n_terms
    kind = made.rows.schema["ids"].dataType.elementType
    out = T.StructType().add("query", "long").add("score", "long").add("id", kind)

    def of_shard(lists: pa.Table, about: pa.Table) -> pa.Table:
        names = ["query", "score", "id"]
        if not lists.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2 + [pa.array([], about["ids"].type.value_type)], names=names)
        sizes = np.frombuffer(about["sizes"][0].as_buffer(), np.int64)
        of = Lists(lists["docs"].to_pylist(), lists["times"].to_pylist(), sizes, n_docs, n_terms)
        weights = lists["weight"].to_numpy()
        own = defaultdict(list)
        for slot, queries in enumerate(lists["queries"].to_pylist()):
            for query in queries:
                own[query].append(slot)
        bar = dict(about["bars"][0].as_py() or [])
        found = []
        for query, slots in own.items():
            slots = np.array(slots)
            docs, scores, _ = of.best(slots, weights[slots], limit, bar.get(query, 1))
            found.append((np.full(len(docs), query), scores, docs))
        query, score, doc = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
        ids = about["ids"].combine_chunks().flatten().take(pa.array(doc))
        return pa.table([pa.array(query), pa.array(score), ids], names=names)

    about = made.rows.where(F.col("term").isNull() & shards).select(F.col("shard").alias("of_shard"), "ids", "sizes")
    about = about.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(bars, "block")
    groups = lists.where(shards).groupBy("block", "shard").cogroup(about.groupBy(F.col("block").alias("of_block"), "of_shard"))
    return written(groups.applyInArrow(of_shard, out), name)


def _best(found: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` best rows of each query, numbered; each task cuts its own rows to them before the shuffle."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit)


def search(made: Index, queries: DataFrame, id_col: str = "item_id", text_col: str = "text", limit: int = 50) -> DataFrame:
    """(item_id, rank, id, score): the ``limit`` documents with the highest scores above 0 for each row of ``queries``.

    The score sums over the different terms of the query weight * impact, in whole numbers: the weight is
    floor(1000 * ln((2 * N + 2) / (2 * df + 1))), the impact (10**9 * tf) div (1000 * tf + 20 * m), where m is
    50 + (50 * length * N) div L. Equal scores stand by ascending id, a null id last. A query without a known
    term, null or empty, has no rows; rows of ``queries`` with the same id are queries of their own.
    """
    asked = queries.select(F.col(id_col).alias("item_id"), query_terms(text_col).alias("terms"))
    asked = written(asked.select(F.monotonically_increasing_id().alias("query"), "item_id", "terms"), "queries")
    blocks = max(1, math.ceil(asked.count() / BLOCK))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks))
    wanted = asked.select(block.alias("block"), "query", F.explode("terms").alias("term"))
    wanted = wanted.groupBy("block", "term").agg(F.collect_list("query").alias("queries"))
    size = F.octet_length("term") + 8 * F.size("queries") + 64
    wanted = written(wanted.withColumn("bytes", size), "query_terms")
    small = (wanted.agg(F.sum("bytes")).first()[0] or 0) <= BROADCAST_BYTES
    wanted = wanted.drop("bytes")

    def beside(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    some = made.rows.where("term is not null")
    df = some.select("term", "n").join(beside(wanted.select("term").distinct()), "term").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * made.n_docs + 2) / (2 * F.col("df") + 1)))
    weighed = written(wanted.join(df.select("term", weight.alias("weight")), "term"), "term_weights")
    lists = some.select("shard", "term", "docs", "times").join(beside(weighed), "term")
    known = asked.select("query", block.alias("block"))

    def bars(scores: DataFrame | None) -> DataFrame:
        rows = known.withColumn("score", F.lit(1).cast("long")) if scores is None else known.join(scores, "query")
        each = F.map_from_entries(F.collect_list(F.struct("query", "score")))
        return rows.groupBy("block").agg(each.alias("bars"))

    first = F.pmod(F.xxhash64("shard"), F.lit(FIRST)) == 0
    start = _search(made, lists, bars(None), first, blocks, limit, "found_first")
    reached = _best(start, limit).where(F.col("rank") == limit).select("query", "score")
    low = known.select("query").join(reached, "query", "left").select("query", F.coalesce("score", F.lit(1).cast("long")).alias("score"))
    rest = _search(made, lists, bars(low), ~first, blocks, limit, "found_rest")
    return _best(start.unionByName(rest), limit).join(asked.select("query", "item_id"), "query").select("item_id", "rank", "id", "score")
