"""The Jaccard join and the suffix deduplication against brute force."""

import hashlib
import os
import random
import sys
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus import awkward, docs, words
from punctual.llm import jaccard, suffixes


def shingles(text):
    parts = (text or "").encode().split()
    n = min(5, len(parts))
    return {tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)} if parts else set()


def brute_joined(rows):
    """(id, class, links, kept) of each row by comparing all with all."""
    sets = [shingles(r[1]) for r in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    rank = {k: n for n, k in enumerate(order)}
    for a in range(len(rows)):
        for b in range(a):
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) > 0:
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)), key=rank.get)
                root[y] = x
    return Counter((r[0], rows[find(k)][0], links[k]) for k, r in enumerate(rows)), len({find(k) for k in range(len(rows))})


def families(n=25, seed=3):
    """Groups of near copies, some in a chain of changes, some copied, and texts that share a passage."""
    rng, rows = random.Random(seed), []
    passage = words(30, 999)
    for f in range(n):
        text = words(rng.randrange(6, 120), 100 + f).split(" ")
        for _ in range(rng.randrange(1, 14)):
            rows.append((len(rows), " ".join(text), "en", "a"))
            if rng.random() < 0.3:
                rows.append((len(rows), "  ".join(text), "en", "a"))
            text = list(text)
            text[rng.randrange(len(text))] = f"new{len(rows)}"
        rows.append((len(rows), passage + " " + words(20 + 4 * f, 500 + f), "en", "a"))
    return rows


def got(df):
    rows = df.collect()
    return Counter((r["id"], r["class_id"], r["n_links"]) for r in rows), sum(r["kept"] for r in rows)


def test_join_finds_all_links(spark):
    rows = families()
    assert got(jaccard.joined(docs(spark, rows))) == brute_joined(rows)


def test_join_in_blocks_and_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "broadcast_if_small", lambda df, rows: df)
    rows = families(8)
    assert got(jaccard.joined(docs(spark, rows), block=4)) == brute_joined(rows)


def test_join_of_awkward_rows(spark):
    rows = awkward()
    assert got(jaccard.joined(docs(spark, rows))) == brute_joined(rows)
    df = docs(spark, rows)
    kept = jaccard.one_of_each(df)
    assert kept.columns == df.columns
    assert kept.count() == brute_joined(rows)[1]
    assert jaccard.joined(docs(spark, [])).count() == 0
    assert jaccard.one_of_each(docs(spark, [])).count() == 0


def test_a_large_group_of_near_copies_is_linked_in_full(spark):
    base = words(80, 1).split(" ")
    rows = []
    for i in range(300):
        text = list(base)
        text[i % 80] = f"own{i}"
        rows.append((i, " ".join(text), "en", "a"))
    links, kept = got(jaccard.joined(docs(spark, rows), block=64))
    assert (links, kept) == brute_joined(rows)


def test_banding_reaches_its_recall():
    bands, rows = jaccard.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= jaccard.RECALL and bands * rows <= jaccard.HASHES
    with pytest.raises(ValueError, match="recall"):
        jaccard.banding(0.1, 0.999999, 10)
    own, rng = jaccard.Bands(bands, rows), np.random.default_rng(1)
    met = 0
    for _ in range(200):
        grams = rng.integers(0, 2**63, 300, np.uint64)
        a, b = np.sort(grams[:267]), np.sort(np.concatenate([grams[:234], grams[267:]]))
        met += bool((own.of(a) == own.of(b)).any())
    assert met >= 199


def brute_repeats(rows, length=50):
    """(id, bytes, removed, runs, digest of what is left) of each row."""
    raws = [(r[0], (r[1] or "").encode()) for r in rows]
    least = {}
    for i, raw in raws:
        key = 2**63 if i is None else i
        for s in range(len(raw) - length + 1):
            least[raw[s : s + length]] = min(least.get(raw[s : s + length], key), key)
    out = Counter()
    for i, raw in raws:
        gone = bytearray(len(raw))
        for s in range(len(raw) - length + 1):
            if least[raw[s : s + length]] < (2**63 if i is None else i):
                gone[s : s + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and not (k and gone[k - 1]))
        out[i, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()] += 1
    return out


def cut_rows(df):
    return Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect())


def passages():
    rng = random.Random(8)
    shared = [words(n, 70 + n) for n in (9, 12, 15, 30)] + ["é漢" * 30, "a" * 120, "ab" * 80]
    rows = []
    for i in range(120):
        parts = [words(rng.randrange(1, 30), 1000 + i)]
        for _ in range(rng.randrange(4)):
            piece = rng.choice(shared)
            a = rng.randrange(len(piece) // 2)
            parts += [piece[a : a + rng.randrange(20, len(piece))], words(rng.randrange(1, 8), 3000 + 7 * len(parts) + i)]
        rows.append((i * 3 % 121, (" " if i % 2 else "").join(parts), "en", "a"))
    return rows + [(200, "a" * 500, "en", "a"), (201, "a" * 49, "en", "a"), (202, "a" * 50, "en", "a"), (None, shared[3], "en", "a")]


def test_repeats_are_removed(spark):
    rows = passages()
    assert cut_rows(suffixes.without_repeats(docs(spark, rows).repartition(5))) == brute_repeats(rows)


def test_repeats_by_aggregation_and_shuffle(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "broadcast_if_small", lambda df, rows: df)
    rows = passages()
    assert cut_rows(suffixes.without_repeats(docs(spark, rows).repartition(5), bucket=20, hot=2)) == brute_repeats(rows)


def test_repeats_in_awkward_rows(spark):
    rows = awkward()
    assert cut_rows(suffixes.without_repeats(docs(spark, rows))) == brute_repeats(rows)
    assert suffixes.without_repeats(docs(spark, [])).count() == 0


def test_repeats_when_little_is_held_at_once(spark, monkeypatch):
    for name, n in (("CHUNK", 200), ("HELD_SEEDS", 50), ("HELD_PIECES", 30), ("SENT", 4), ("SORTED", 8)):
        monkeypatch.setattr(suffixes, name, n)
    rows = passages()
    assert cut_rows(suffixes.without_repeats(docs(spark, rows).repartition(3))) == brute_repeats(rows)


def test_texts_become_bytes_a_chunk_at_a_time(monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 100)
    seen = []

    class Text(str):
        def encode(self, *how):
            seen.append(str(self))
            return str.encode(self, *how)

    texts = [Text("é" * n) for n in (10, 20, 30, 0, 200, 5)]
    parts, most = [], []
    for rows, raw in suffixes.chunks(iter([pd.DataFrame({"id": range(6), "text": texts}), pd.DataFrame({"id": [], "text": []})])):
        assert len(rows) == len(raw)
        parts += zip(rows["id"], raw, strict=True)
        most.append(len(seen))
    assert parts == [(n, t.encode()) for n, t in enumerate(map(str, texts))]
    assert most == [3, 5, 6]


def test_tasks_give_back_what_they_took(spark, monkeypatch, tmp_path):
    place = str(tmp_path)

    def told():
        open(os.path.join(place, sys._getframe(1).f_code.co_name), "w").close()

    monkeypatch.setattr(suffixes, "give_back", told)
    suffixes.without_repeats(docs(spark, passages())).collect()
    assert set(os.listdir(place)) >= {"collect", "find", "compare", "apply"}


@given(st.lists(st.binary(min_size=1, max_size=6), max_size=300), st.integers(2, 9))
@settings(max_examples=60, deadline=None)
def test_multikey_quicksort(keys, small):
    words_ = np.array([list(k.ljust(6, b"\0")) for k in keys], np.uint64).reshape(-1, 6)
    order = suffixes.multikey_order(words_, small)
    assert sorted(order.tolist()) == list(range(len(keys)))
    assert words_[order].tolist() == sorted(words_.tolist())


@given(st.lists(st.text("ab é", max_size=150), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_pieces_hold_every_string_once(texts):
    raw = [t.encode() for t in texts]
    seed, text, first, count, place = suffixes.pieces(raw, 50)
    whole, starts = b"".join(raw), np.cumsum([0, *map(len, raw)])
    held = sorted(int(f) + k for f, c in zip(first, count, strict=True) for k in range(c))
    assert held == [int(s) + k for s, r in zip(starts, raw, strict=False) for k in range(len(r) - 49)]
    filed = {}
    for s, f, c, p in zip(seed, first, count, place, strict=True):
        for k in range(int(f), int(f + c)):
            assert filed.setdefault(whole[k : k + 50], (int(s), whole[p : p + 24])) == (int(s), whole[p : p + 24])


@given(st.binary(max_size=60), st.lists(st.tuples(st.integers(0, 60), st.integers(1, 20)), max_size=8))
def test_cut(text, spans):
    spans = [(a, min(a + n, len(text))) for a, n in spans if a < len(text)]
    gone = {k for a, b in spans for k in range(a, b)}
    runs = sum(1 for k in gone if k - 1 not in gone)
    want = bytes(b for k, b in enumerate(text) if k not in gone)
    assert suffixes.cut(text, [a for a, _ in spans], [b for _, b in spans]) == (len(gone), runs, want)
