import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpus import awkward, docs
from punctual.llm import dedup, mixing
from punctual.llm.common import components, ranked


def flat(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_copies(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[flat(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        least = min(ids, key=lambda i: (i is None, i or 0))
        first = True
        for i in sorted(ids, key=lambda i: (i is None, i or 0)):
            out.append((i, least, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
            first = False
    return Counter(out)


def test_copies_of_awkward_rows(spark):
    rows = awkward()
    got = Counter(tuple(r) for r in dedup.copies(docs(spark, rows)).collect())
    assert got == brute_copies(rows)


def test_drop_copies_keeps_one_row_of_each_text_with_all_columns(spark):
    df = docs(spark, awkward())
    kept = dedup.drop_copies(df)
    assert kept.columns == df.columns
    want = Counter((i, flat(t)) for i, t, *_ in {(flat(t)): (i, t) for i, t, *_ in sorted(
        awkward(), key=lambda r: (r[0] is None, r[0] or 0), reverse=True)}.values())
    assert Counter((r["doc_id"], flat(r["text"])) for r in kept.collect()) == want


def test_bits_set_twice_cover_every_copy_and_few_others(spark):
    rows = [(i, f"text {i // 2 if i < 200 else i}", "en", "a") for i in range(4000)]
    digests = docs(spark, rows).select(dedup.text_digest("text").alias("digest"))
    tested = dedup._tested(digests, dedup.repeated_bits(digests))
    assert 200 <= tested.where("maybe").count() < 600


def test_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(dedup, "broadcast_if_small", lambda df, rows: df)
    rows = awkward()
    assert Counter(tuple(r) for r in dedup.copies(docs(spark, rows)).collect()) == brute_copies(rows)


def test_empty_table(spark):
    empty = docs(spark, [])
    assert dedup.copies(empty).count() == 0
    assert dedup.drop_copies(empty).count() == 0
    assert mixing.mix_plan(empty).count() == 0
    assert mixing.mixed(empty).count() == 0


def water(sizes, weights, total, most=2):
    """Targets by filling up step by step."""
    target, open_ = {}, dict(zip(sizes, weights, strict=True))
    while open_:
        level = (total - sum(target.values())) / sum(open_.values())
        full = [s for s, w in open_.items() if w * level >= most * sizes[s]]
        if not full:
            return target | {s: w * level for s, w in open_.items()}
        for s in full:
            target[s] = most * sizes[s]
            del open_[s]
    return target


@pytest.fixture
def mix_rows():
    return [(i, "w " * (i % 37 + 1), "en", "abcde"[min(i % 9, 4)] if i % 11 else None) for i in range(3000)]


def test_mix_meets_targets(spark, mix_rows):
    plan = mixing.mix_plan(docs(spark, mix_rows)).toPandas()
    sizes = {(s or "~"): int(g) for s, g in plan.groupby(plan["source"].fillna("~"))["size"].sum().items()}
    weights = [(3, 1, 2)[k % 3] for k in range(len(sizes))]
    want = water(sizes, weights, 1.5 * sum(sizes.values()))
    for name, group in plan.groupby(plan["source"].fillna("~")):
        assert group["target"].iloc[0] == pytest.approx(want[name])
        assert group["taken"].sum() == pytest.approx(want[name], abs=2 * 37)
    assert (plan["taken"] <= 2 * plan["size"]).all()


def test_mix_does_not_depend_on_layout_or_cells(spark, mix_rows, monkeypatch):
    df = docs(spark, mix_rows)
    one = Counter(tuple(r) for r in mixing.mix_plan(df).collect())
    monkeypatch.setattr(mixing, "ROWS_PER_CELL", 10)
    assert Counter(tuple(r) for r in mixing.mix_plan(df.repartition(7)).collect()) == one
    again = Counter()
    for r, n in one.items():
        again[r[0], r[1]] += n * r[5]
    mixed = Counter((r["doc_id"], r["source"]) for r in mixing.mixed(df).collect())
    assert mixed == Counter({k: n for k, n in again.items() if n})


def test_mix_of_awkward_rows(spark):
    df = docs(spark, awkward())
    plan = mixing.mix_plan(df).toPandas()
    assert len(plan) == len(awkward())
    assert plan.loc[plan["size"] == 0, "taken"].eq(0).all()
    assert mixing.mixed(df).columns == df.columns


def test_sources_without_words(spark):
    plan = mixing.mix_plan(docs(spark, [(1, None, "en", "a"), (2, "", "en", None)])).collect()
    assert [(r["size"], r["taken"]) for r in plan] == [(0, 0), (0, 0)]


def test_ranks_without_one_task(spark):
    df = spark.range(1000).select(F.xxhash64("id").alias("v"))
    got = [r["v"] for r in ranked(df, ["v"], "t").orderBy("rank").collect()]
    assert got == sorted(r["v"] for r in df.collect())


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 50 + i) for i in range(40)] + [(200, 201), (201, 200), (7, 7)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(31)} | {50 + i: 50 for i in range(40)} | {100: 50, 200: 200, 201: 200}
