"""Removal of byte strings that also start in a document with a smaller id, by sorting suffixes.

Only suffixes that may repeat are sorted. A string of ``length`` bytes is filed under the least hash of
its ``SEED``-byte substrings, so equal strings are filed alike, and neighbouring strings of a text
mostly under the same seed: they travel as one row, the piece of text that they span.

1. Tasks send the seeds of their texts, a few bytes each, to the part of the hash range that they fall in.
   What arrives there twice goes into a bitmap that all tasks read from the shared folder.
2. Texts are read again. Pieces whose seed is not in the bitmap are unique. Of equal pieces within a task
   only the one with the smallest id goes on; the others are settled there.
3. Sampled splitters range-partition the pieces by their seed's bytes. A bucket expands its
   pieces to suffixes, sorts them by multikey quicksort and compares neighbours. Splitters
   lie between seeds, so equal strings never lie on two sides of a boundary. A seed with too many
   pieces for one bucket is aggregated by its strings instead.

Whole copies of a text with a smaller id are settled first and take no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import broadcast_if_small, give_back, text_or_empty, written
from punctual.session import shared_path

LENGTH, SEED = 50, 24
#: Strings that one row stands for at most, bytes worked on at once, seeds and pieces held by a task, rows sent at once.
PER_PIECE, CHUNK, HELD_SEEDS, HELD_PIECES, SENT = 32, 1 << 18, 1_000_000, 400_000, 20_000
#: Seeds per part of the hash range, bits of the bitmap per seed and in all.
PART, BITS_PER_SEED, MOST_BITS = 1 << 20, 16, 1 << 28
#: Pieces per bucket, of these sorted at once, and pieces of one seed beyond which its strings are aggregated.
BUCKET, SORTED, HOT = 50_000, 10_000, 50_000

_random = np.random.default_rng(50)
_byte = _random.integers(1, 2**63, 256, np.uint64)
_odd = _random.integers(0, 2**63, 8, np.uint64) * np.uint64(2) + np.uint64(1)


def seed_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the SEED bytes from each position on; doubles 1, 2, 4, 8 and 16 bytes and joins 16 and 8."""
    h, spans = _byte[raw], []
    for k in range(4):
        step = 1 << k
        h = h[:-step] * _odd[k] + h[step:]
        h ^= h >> np.uint64(31)
        spans.append(h)
    eight, sixteen = spans[2], spans[3]
    out = sixteen[: len(raw) - SEED + 1] * _odd[5] + eight[16 : 16 + len(raw) - SEED + 1]
    out ^= out >> np.uint64(32)
    out *= _odd[6]
    return out | np.uint64(1)


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    span, out = 1, h
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def pieces(
    texts: list[bytes], length: int = LENGTH, places: bool = True
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of ``texts`` put end to end: (seed hash, text number, first string, number of strings, place of the seed).

    All strings of a piece have the same least seed. Strings lie within one text. Without ``places`` these are 0.
    """
    sizes = np.array([len(t) for t in texts])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    none = np.empty(0, np.int64)
    if len(raw) < length:
        return none.astype(np.uint64), none, none, none, none
    ends = np.cumsum(sizes)
    h = seed_hashes(raw)
    width = length - SEED + 1
    least = _sliding_min(h, width)
    for end in ends[:-1]:
        least[max(0, end - length + 1) : end] = 0  # strings across the end of a text; no hash is 0
    new = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    runs = np.diff(np.append(new, len(least)))
    new, runs = new[least[new] != 0], runs[least[new] != 0]
    parts = -(-runs // PER_PIECE)  # long runs, as in periodic text, are cut
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(new, parts) + nth * PER_PIECE
    count = np.minimum(np.repeat(new + runs, parts) - first, PER_PIECE)
    seed = least[first]
    place = np.zeros(len(first), np.int64)
    for k in range(0, len(first) if places else 0, SENT):
        at = first[k : k + SENT, None] + np.arange(width)
        place[k : k + SENT] = first[k : k + SENT] + (h[at] == seed[k : k + SENT, None]).argmax(axis=1)
    # least hashes lie low; spread, they fall evenly into the parts of the hash range
    return seed * _odd[7], np.searchsorted(ends, first, "right"), first, count, place


def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    """Rows of the batches with their texts as bytes, about CHUNK bytes at once."""
    for batch in batches:
        raw, size, start = [], 0, 0
        for n, text in enumerate(batch["text"], 1):
            raw.append(text.encode("utf-8", "surrogatepass"))
            size += len(raw[-1])
            if size >= CHUNK or n == len(batch):
                yield batch.iloc[start:n], raw
                raw, size, start = [], 0, n


def _seeds(texts: DataFrame, parts: int, length: int) -> DataFrame:
    """(part, seeds): the seeds of each task by part of the hash range, five bytes each and in order."""
    bits = parts.bit_length() - 1

    def pack(seeds: np.ndarray) -> pd.DataFrame:
        seeds = np.sort(seeds) >> np.uint64(24 - bits if bits < 24 else 0)
        part = (seeds >> np.uint64(40)).astype(np.int64)
        low = (seeds & np.uint64((1 << 40) - 1)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:]
        own, start = np.unique(part, return_index=True)
        stop = np.append(start[1:], len(part))
        return pd.DataFrame({"part": own, "seeds": [low[a:b].tobytes() for a, b in zip(start, stop, strict=True)]})

    def collect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0
        for rows, raw in chunks(batches):
            seed, text, *_ = pieces(raw, length, places=False)
            ids = rows["id"].to_numpy()[text]
            order = np.lexsort((ids, seed))
            seed, ids = seed[order], ids[order]
            again = np.concatenate([[False], seed[1:] == seed[:-1]])
            other = again & np.concatenate([[False], ids[1:] != ids[:-1]])
            held.append(np.concatenate([seed[~again], np.unique(seed[other])]))  # twice if two ids have it
            n += len(held[-1])
            if n >= HELD_SEEDS:
                yield pack(_at_most_twice(np.concatenate(held)))
                held, n = [], 0
        if n:
            yield pack(_at_most_twice(np.concatenate(held)))
        rows = raw = held = seed = ids = order = again = other = text = _ = None
        give_back()

    return texts.mapInPandas(collect, "part bigint, seeds binary")


def _at_most_twice(seeds: np.ndarray) -> np.ndarray:
    values, counts = np.unique(seeds, return_counts=True)
    return np.repeat(values, np.minimum(counts, 2))


def _spots(low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places in a bitmap of so many bits for the 40-bit values of a part."""
    mixed = low * np.uint64(0x9E3779B97F4A7C15)
    mask = np.uint64(bits - 1)
    return (mixed >> np.uint64(34)) & mask, (mixed >> np.uint64(4)) & mask


def _bitmap(rows: pd.DataFrame, most_bits: int) -> pd.DataFrame:
    """(part, bits) of one part: a bitmap of the seeds that came more than once."""
    low = [np.frombuffer(s, np.uint8).reshape(-1, 5) for s in rows["seeds"]]
    wide = np.zeros((sum(map(len, low)), 8), np.uint8)
    wide[:, 3:] = np.concatenate(low)
    seeds = np.sort(wide.reshape(-1).view(">u8").astype(np.uint64))
    twice = np.unique(seeds[1:][seeds[1:] == seeds[:-1]])
    bits = 64
    while bits < len(twice) * BITS_PER_SEED and bits < most_bits:
        bits *= 2
    flags = np.zeros(bits, bool)
    for spot in _spots(twice, bits):
        flags[spot] = True
    out = pd.DataFrame({"part": [int(rows["part"].iloc[0])], "bits": [np.packbits(flags).tobytes()]})
    low = wide = seeds = twice = flags = spot = None
    give_back()
    return out


@lru_cache(maxsize=1)
def _bitmaps(path: str) -> dict[int, np.ndarray]:
    store, inside = fs.FileSystem.from_uri(path)
    held = ds.dataset(inside, filesystem=store, format="parquet").to_table()
    return {p: np.frombuffer(b, np.uint8) for p, b in zip(held["part"].to_pylist(), held["bits"].to_pylist(), strict=True)}


def _may_repeat(seeds: np.ndarray, path: str, parts: int) -> np.ndarray:
    bits = parts.bit_length() - 1
    seeds = seeds >> np.uint64(24 - bits if bits < 24 else 0)
    part, low = (seeds >> np.uint64(40)).astype(np.int64), seeds & np.uint64((1 << 40) - 1)
    maps, out = _bitmaps(path), np.zeros(len(seeds), bool)
    order = np.argsort(part, kind="stable")
    own, start = np.unique(part[order], return_index=True)
    for p, at in zip(own.tolist(), np.split(order, start[1:]), strict=True):
        if (flags := maps.get(p)) is not None:
            hit = np.ones(len(at), bool)
            for spot in _spots(low[at], len(flags) * 8):
                hit &= (flags[(spot >> np.uint64(3)).astype(np.int64)] >> (7 - (spot & np.uint64(7))).astype(np.uint8) & 1) > 0
            out[at] = hit
    return out


def merged(spans: pd.DataFrame) -> pd.DataFrame:
    """Spans (id, h, start, stop) that touch or overlap, as one."""
    if not len(spans):
        return spans
    spans = spans.sort_values(["id", "h", "start"], ignore_index=True)
    doc = (spans["id"].diff().ne(0) | spans["h"].ne(spans["h"].shift())).cumsum()
    reach = spans["stop"].groupby(doc).cummax()
    run = (doc.ne(doc.shift()) | (spans["start"] > reach.shift())).cumsum()
    return spans.groupby(run, sort=False).agg({"id": "first", "h": "first", "start": "min", "stop": "max"})


def _candidates(texts: DataFrame, path: str, parts: int, length: int) -> DataFrame:
    """Pieces that may repeat (id, h, start, stop, lead, piece), and with a null lead spans to remove."""
    names = ["id", "h", "start", "stop"]

    def settle(held: list[tuple]) -> Iterator[pd.DataFrame]:
        *places, own = zip(*held, strict=True)
        ids, hs, start, stop, seed = [np.concatenate(x) for x in places]
        own = np.array([piece for part in own for piece in part], object)
        group, values = pd.factorize(own)
        least = np.full(len(values), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids)
        again = ids > least[group]
        group = values = least = None
        spans = pd.DataFrame({"id": ids[again], "h": hs[again], "start": start[again], "stop": stop[again]})
        if len(spans):
            yield merged(spans).assign(lead=None, piece=None)
        on = np.flatnonzero(~again)
        for k in range(0, len(on), SENT):
            at = on[k : k + SENT]
            leads = [piece[p : p + SEED] for piece, p in zip(own[at], seed[at].tolist(), strict=True)]
            out = pd.DataFrame(dict(zip(names, (ids[at], hs[at], start[at], stop[at]), strict=True)))
            yield out.assign(lead=leads, piece=own[at])

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []  # arrays and the pieces of a chunk; the lead is cut from its piece when it is sent
        n = 0
        for rows, raw in chunks(batches):
            seed, text, first, count, place = pieces(raw, length)
            if not len(seed):
                continue
            some = np.flatnonzero(_may_repeat(seed, path, parts))
            whole = b"".join(raw)
            begin = np.cumsum([0, *map(len, raw)])[text[some]]
            ids, hs = rows["id"].to_numpy()[text[some]], rows["h"].to_numpy()[text[some]]
            first, stop, place = first[some], first[some] + count[some] + length - 1, place[some]
            own = [whole[x:y] for x, y in zip(first.tolist(), stop.tolist(), strict=True)]
            held.append((ids, hs, first - begin, stop - begin, place - first, own))
            n += len(own)
            if n >= HELD_PIECES:
                yield from settle(held)
                held, n = [], 0
        if n:
            yield from settle(held)
        rows = raw = held = own = whole = seed = text = first = count = place = some = begin = ids = hs = stop = None
        give_back()

    return texts.mapInPandas(find, "id bigint, h bigint, start bigint, stop bigint, lead binary, piece binary")


def multikey_order(words: np.ndarray, small: int = 2048) -> np.ndarray:
    """The order of the rows of a matrix by their columns: multikey quicksort, a word being a key.

    A part is split by the pivot's word into less, equal and greater; only the equal part goes on to
    the next word. Small parts are sorted by their remaining words.
    """
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        lo, hi, d = todo.pop()
        if hi - lo < 2 or d == words.shape[1]:
            continue
        own = order[lo:hi]
        if hi - lo <= small:
            order[lo:hi] = own[np.lexsort(words[own, d:].T[::-1])]
            continue
        key = words[own, d]
        pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
        less, more = own[key < pivot], own[key > pivot]
        order[lo:hi] = np.concatenate([less, own[key == pivot], more])
        a, b = lo + len(less), hi - len(more)
        todo += [(lo, a, d), (a, b, d + 1), (b, hi, d)]
    return order


def repeated(rows: pd.DataFrame, length: int) -> pd.DataFrame:
    """Spans of the strings in the pieces of a bucket that a smaller id has too."""
    counts = (rows["stop"] - rows["start"]).to_numpy() - length + 1
    owner = np.repeat(np.arange(len(rows)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.cumsum([0, *map(len, rows["piece"])])[:-1]
    raw = np.frombuffer(b"".join(rows["piece"]) + b"\0" * 8, np.uint8)
    width = -(-length // 8) * 8
    at = begin[owner] + nth
    words = np.zeros((len(at), width), np.uint8)
    for k in range(length):
        words[:, k] = raw[at + k]
    words = words.view(">u8").astype(np.uint64)
    order = multikey_order(words)
    words = words[order]
    new = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]).any(axis=1)]))
    ids = rows["id"].to_numpy()[owner[order]]
    least = np.repeat(np.minimum.reduceat(ids, new), np.diff(np.append(new, len(ids))))
    hit = order[ids > least]
    start = rows["start"].to_numpy()[owner[hit]] + nth[hit]
    spans = pd.DataFrame({"id": rows["id"].to_numpy()[owner[hit]], "h": rows["h"].to_numpy()[owner[hit]], "start": start, "stop": start + length})
    return merged(spans)


def _sorted_buckets(found: DataFrame, buckets: int, length: int) -> DataFrame:
    """Spans from the pieces of each bucket of the range of leads."""

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [b for b in batches if len(b)]
        if held:
            rows = pd.concat(held, ignore_index=True)
            held = None
            # by groups of whole leads, so that the suffixes of a part are bounded
            rows = rows.sort_values("lead", kind="stable", ignore_index=True)
            new = np.flatnonzero(rows["lead"].ne(rows["lead"].shift()).to_numpy())
            cuts = [int(new[k]) for k in range(len(new)) if k == 0 or new[k] // SORTED != new[k - 1] // SORTED]
            for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True):
                yield repeated(rows.iloc[a:b].reset_index(drop=True), length)
        rows = new = None
        give_back()

    dealt = found.repartitionByRange(buckets, "lead")
    return dealt.mapInPandas(compare, "id bigint, h bigint, start bigint, stop bigint")


def _aggregated(found: DataFrame, length: int) -> DataFrame:
    """The same spans by an aggregation of each string, for seeds with too many pieces."""
    each = F.posexplode(F.expr(f"transform(sequence(1, length(piece) - {length - 1}), i -> substring(piece, i, {length}))"))
    strings = written(found.select("id", "h", "start", each.alias("nth", "string")), "hot_strings")
    least = written(strings.groupBy("string").agg(F.min("id").alias("least")), "hot_owners")
    hit = strings.join(least, "string").where(F.col("id") > F.col("least"))
    begin = F.col("start") + F.col("nth")
    return hit.select("id", "h", begin.alias("start"), (begin + length).alias("stop"))


def repeated_spans(texts: DataFrame, length: int = LENGTH, bucket: int = BUCKET, hot: int = HOT) -> DataFrame:
    """(id, h, start, stop) of what to remove from ``texts`` (id, h, text); spans may overlap."""
    spark = texts.sparkSession
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = 16
    while parts * PART < total // 8:
        parts *= 2
    most = max(64, MOST_BITS // parts)
    seeds = _seeds(texts, parts, length)
    maps = seeds.groupBy("part").applyInPandas(lambda rows: _bitmap(rows, most), "part bigint, bits binary")
    path = shared_path(spark, "bitmaps")
    maps.write.parquet(path)
    found = _candidates(texts, path, parts, length)
    place = shared_path(spark, "pieces")
    found.write.option("compression", "zstd").parquet(place)
    found = spark.read.schema(found.schema).parquet(place)
    settled = found.where("lead is null").select("id", "h", "start", "stop")
    open_ = found.where("lead is not null")
    n = open_.count()
    heavy = written(open_.groupBy("lead").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("lead"), "hot_seeds")
    n_heavy = heavy.count()
    light = open_
    if n_heavy:
        marks = broadcast_if_small(heavy, n_heavy)
        settled = settled.unionByName(_aggregated(open_.join(marks, "lead", "left_semi"), length))
        light = open_.join(marks, "lead", "left_anti")
    least_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return settled.unionByName(_sorted_buckets(light, max(least_buckets, n // bucket + 1), length))


def cut(text: bytes, starts, stops) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs of them, and what is left."""
    kept, at, removed, runs = [], 0, 0, 0
    for start, stop in sorted(zip(starts, stops, strict=True)):
        if start > at or not runs:
            kept.append(text[at:start])
            runs += 1
            at = start
        if stop > at:
            removed += stop - at
            at = stop
    kept.append(text[at:])
    return removed, runs, b"".join(kept)


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, bucket: int = BUCKET, hot: int = HOT
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept (binary, the bytes left).

    Texts are UTF-8 bytes, null is empty. A byte goes if a string of ``length`` bytes that covers it also
    starts in a document with a smaller id; strings are those of the input. Equal ids are not
    smaller, so repeated rows do not remove each other; a null id is larger than any other. Ids are integers.
    """
    top = F.lit(2**63 - 1)
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    rows = rows.withColumns({"no": F.coalesce(F.col("id").cast("long"), top), "h": F.xxhash64("text"), "digest": F.unhex(F.sha2("text", 256))})
    first = rows.where(F.octet_length("text") >= length).groupBy("digest").agg(F.min("no").alias("first"), F.count("*").alias("n"))
    first = written(first.where("n > 1").select("digest", "first"), "whole_copies")
    marked = rows.join(broadcast_if_small(first, first.count()), "digest", "left").drop("digest")
    copy = F.coalesce(F.col("first") < F.col("no"), F.lit(False))
    texts = marked.where(~copy).select(F.col("no").alias("id"), "h", "text")
    spans = written(repeated_spans(texts, length, bucket, hot), "spans")
    by_text = spans.groupBy(F.col("id").alias("no"), "h").agg(
        F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops")
    )
    # spans grow with the texts: both shuffle, once, at any size; copies stay out of it
    joined = marked.where(~copy).join(by_text.hint("shuffle_hash"), ["no", "h"], "left")

    def apply(batches):
        for texts, starts, stops in batches:
            out = [cut(t.encode("utf-8", "surrogatepass"), a, b) for t, a, b in zip(texts, starts, stops, strict=True)]
            yield pd.DataFrame(out, columns=["removed", "runs", "kept"])
            texts = starts = stops = out = None
        give_back()

    apply.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    made = F.pandas_udf(apply, "removed bigint, runs bigint, kept binary")("text", "starts", "stops")
    size = F.octet_length("text").cast("long")
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    kept = F.col("text").cast("binary").alias("kept")
    copies = marked.where(copy).select("id", size.alias("n_bytes"), size.alias("n_removed"), one.alias("n_spans"), F.lit(b"").alias("kept"))
    whole = joined.where("starts is null").select("id", size.alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), kept)
    part = joined.where("starts is not null").select("id", size.alias("n_bytes"), made.alias("m"))
    part = part.select("id", "n_bytes", F.col("m.removed").alias("n_removed"), F.col("m.runs").alias("n_spans"), F.col("m.kept").alias("kept"))
    return copies.unionByName(whole).unionByName(part)
