"""The hash trees, the ranked search and the vector groups against brute force, and on awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from punctual.llm import merkle, search, vectors

SF = "/root/testdata/sf0.001"
PARTS = ["doc_id", "source", "lang", "n_chars", "text"]
ROWS = "doc_id long, source string, lang string, n_chars long, text string"


# hash trees


def _hash(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def _leaf(row, more=0):
    n = None if row["n_chars"] is None else row["n_chars"] + more
    values = (row["doc_id"], row["source"], row["lang"], n, row["text"])
    return _hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([_hash(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def _manifest(rows):
    """Level by level over plain lists, without blocks or addresses."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, _leaf(row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: _levels([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in names}
    top = _levels([trees[g][-1][0] for g in names])
    out = []
    for at_top, g in enumerate(names):
        for at_leaf, (_, _, leaf, row) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            touched = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            now, met = _leaf(row, 1) if touched else leaf, []
            for levels, at in ((trees[g], at_leaf), (top, at_top)):
                for level in levels[:-1]:
                    other = level[at ^ 1] if at ^ 1 < len(level) else None
                    met += [other] if other else []
                    now = _hash(now) if other is None else _hash(now, other) if at % 2 == 0 else _hash(other, now)
                    at //= 2
            out.append((row["doc_id"], leaf, trees[g][-1][0], top[-1][0], _hash(*met), now, now == top[-1][0]))
    return sorted(out, key=str)


def _proved(docs, height):
    tampered = merkle.row_hash(["doc_id", "source", "lang", F.col("n_chars") + 1, "text"])
    touched = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    made = merkle.manifest(docs, PARTS, "lang", "doc_id", {"changed": F.when(touched, F.unhex(tampered))}, height)
    rows = merkle.proofs(made, "changed").collect()
    return sorted([(r.id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows], key=str)


@pytest.mark.parametrize("levels", range(1, 9))
def test_addresses_fill_the_tree_and_keep_subtrees_together(levels):
    found = [merkle.address(d, i, levels) for d in range(levels) for i in range(1 << d)]
    assert sorted(found) == list(range((1 << levels) - 1))
    top = levels // 2
    if top:
        bottom = levels - top
        for sub in range(1 << top):
            below = [merkle.address(top + d, (sub << d) + i, levels) for d in range(bottom) for i in range(1 << d)]
            assert max(below) - min(below) == len(below) - 1
            assert [x - min(below) for x in below] == [merkle.address(d, i, bottom) for d in range(bottom) for i in range(1 << d)]


@pytest.mark.parametrize("height", [2, 12])
def test_proofs_equal_plain_trees(spark, height):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert _proved(docs, height) == _manifest(docs.collect())


def test_manifest_of_awkward_rows(spark):
    rows = [
        (None, "s", None, 1, "x"), (1, None, None, None, None), (1, None, None, None, None), (2, "", "", 0, ""),
        (3, "s", "é", 5, "yé"), (3, "s", "é", 6, "yé"), (4, "long", "en", 400_000, "ab" * 200_000),
    ]
    docs = spark.createDataFrame(rows, ROWS).withColumns({"digest": F.lit("d"), "pos": F.lit(9), "name": F.lit("n")})
    assert _proved(docs, 1) == _manifest(docs.collect())
    alone = docs.where("doc_id = 4")
    [(_, leaf, subroot, root, proof, folded, _)] = _proved(alone, 3)
    assert leaf == subroot == root and proof == _hash()
    assert _proved(docs.limit(0), 3) == []


def test_one_group_of_copies_is_spread_over_ranges(spark):
    docs = spark.range(4000).select(
        F.lit(1).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.lit("en").alias("lang"),
        F.lit(1).cast("long").alias("n_chars"), F.lit("t").alias("text"),
    )
    made = merkle.manifest(docs, PARTS, "lang", "doc_id", height=5)
    assert len(made.tiers) == 3
    assert sorted(r["pos"] for r in made.leaves.select("pos").collect()) == list(range(4000))
    assert _proved(docs, 5) == _manifest(docs.collect())


# ranked search


def _ranked(docs, items, limit):
    texts = [(i, search.terms(t.encode())) for i, t in docs if t is not None]
    texts = [(i, t) for i, t in texts if t]
    n_docs, n_terms = len(texts), sum(len(t) for _, t in texts)
    df = Counter(w for _, t in texts for w in set(t))
    out = []
    for item, query in items:
        found = []
        for i, words in texts:
            counts, m = Counter(words), 100 - 50 + (50 * len(words) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * counts[w]) // (1000 * counts[w] + 20 * m))
                for w in set(search.terms((query or "").encode())) if counts[w]
            )
            if score > 0:
                found.append((-score, i is None, i if i is not None else 0, i))
        out += [(item, n + 1, f[3], -f[0]) for n, f in enumerate(sorted(found)[:limit])]
    return sorted(out, key=str)


def _searched(spark, docs, items, limit):
    made = search.index(docs)
    rows = search.search(made, items, limit=limit).collect()
    return sorted([(r.item_id, r["rank"], r.id, r.score) for r in rows], key=str)


def _corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Éa", "漢字", "X-y"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(rng.randrange(200), " ".join(rng.choices(vocabulary, weights, k=rng.choice([1, 5, 40])))) for _ in range(n)]


@pytest.mark.parametrize("parts", [1, 40])
def test_search_equals_brute_force(spark, parts):
    """A task makes a shard of its own, so more parts are more shards."""
    rows = _corpus(1) + [(None, None), (7, ""), (None, "w0 w1 w2"), (None, "w0 w1 w2"), (8, "w3 " * 30_000)]
    items = [(1, "w0 W1 w5!"), (2, "w40 漢字 éa"), (3, None), (4, ""), (5, "unknown"), (5, "w2 w2 x y"), (None, "w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"term": F.lit("t"), "n": F.lit(1)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("query", F.lit("q"))
    docs = docs.repartition(parts)
    for limit in (3, 50):
        assert _searched(spark, docs, asked, limit) == _ranked(rows, items, limit)


def test_search_of_empty_tables(spark):
    docs, asked = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert _searched(spark, docs.limit(0), asked, 5) == []
    assert _searched(spark, docs, asked.limit(0), 5) == []


def test_best_first_splits_few_intervals_and_prunes_ties():
    rng = np.random.default_rng(0)
    n = 5000
    docs = [np.sort(rng.choice(n, size, False)).astype(np.uint16) for size in (4000, 500, 20)]
    times = [rng.integers(1, 4, len(d)).astype(np.uint32) for d in docs]
    lists = search.Lists([d.tobytes() for d in docs], [t.tobytes() for t in times], np.full(n, 100), n, 100 * n)
    found, scores, split = lists.best(np.arange(3), np.array([100, 2000, 7000]), 10, 1)
    total = np.zeros(n, np.int64)
    for k, w in enumerate((100, 2000, 7000)):
        total[docs[k]] += w * lists.impact[lists.starts[k] : lists.ends[k]]
    best = np.lexsort((np.arange(n), -total))[:10]
    assert list(found) == list(best) and list(scores) == list(total[best])
    assert split < 500
    # all documents alike: the first ones win, and no others are looked at
    same = search.Lists([np.arange(n).astype(np.uint16).tobytes()], [np.ones(n, np.uint32).tobytes()], np.full(n, 10), n, 10 * n)
    found, _, split = same.best(np.array([0]), np.array([5]), 10, 1)
    assert list(found) == list(range(10)) and split < 200


# vector groups


def _grouped(rows, cosine=0.95):
    def unit(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        x = np.array(v, float) / max(abs(y) for y in v)
        return x / np.linalg.norm(x)

    units = [unit(v) for _, v in rows]
    n = len(rows)
    link = [
        [j for j in range(n) if j != i and units[i] is not None and units[j] is not None
         and len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= cosine]
        for i in range(n)
    ]
    out, seen = [None] * n, set()
    for i in range(n):
        if i in seen:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in link[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        ids = [rows[j][0] for j in group]
        least = min((x for x in ids if x is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(link[j]), least)
    return sorted(out, key=str)


def _cloud(seed, n, dim, groups, noise):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    out = centres[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, dim))
    return [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(n), out, strict=True)]


def _found(df, **rules):
    rows = vectors.joined(df, **rules).collect()
    assert sum(r.kept for r in rows) == len({r.component_id for r in rows if r.component_id is not None}) + sum(
        r.kept for r in rows if r.component_id is None
    )
    return sorted([(r.id, r.n_links, r.component_id) for r in rows], key=str)


@pytest.mark.parametrize("block", [16, 4096])
def test_vectors_equal_brute_force(spark, block):
    rows = _cloud(1, 400, 16, 40, 0.15)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _found(df, block=block, cell=40) == _grouped(rows)
    assert _found(df, block=block, cell=40, reach=None) == _grouped(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [0.0, 0.0]), (5, None), (6, [1.0, None]), (7, [nan, 1.0]),
        (8, [inf, 0.0]), (9, []), (None, [1.0, 0.0]), (None, [-1.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]),
        (11, [1.0, 0.0, 0.0]), (12, [1.0]), (13, [-2.0]), (14, [3e200, 1e200]), (15, [3e-200, 1e-200]), (16, [-0.0, 5.0]), (17, [0.0, 5.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    df = df.withColumns({"key": F.lit("k"), "node": F.lit(1), "home": F.lit(2), "first": F.lit(3)})
    assert _found(df) == _grouped(rows)
    assert _found(df.limit(0)) == []


def test_a_dense_group_stays_in_few_cells(spark):
    """Most rows near one direction: the centres there become one, so no member visits many cells."""
    rng = np.random.default_rng(3)
    near = [1.0] + [0.0] * 31 + 0.02 * rng.normal(size=(1500, 32))
    x = np.concatenate([near, rng.normal(size=(500, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = vectors.spherical_means(x, 20)
    home, visits = vectors.cells_of(x[:1500], centres, vectors.margin(32))
    assert sum(len(v) for v in visits) < 1500
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = _found(df, cell=100, block=300)
    assert sum(n == 1499 for _, n, _ in found) == 1500 and sum(n for _, n, _ in found) == 1500 * 1499


def test_margin():
    exact = math.sqrt(0.1) / 2
    assert vectors.margin(2) == vectors.margin(64, reach=None) == pytest.approx(exact)
    assert vectors.margin(64) == pytest.approx(exact / 2)
    assert vectors.margin(64, cosine=1.0) == 0
