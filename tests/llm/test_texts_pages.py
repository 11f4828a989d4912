"""Language ID, HTML extraction, byte-level BPE and WARC archives."""

import base64
import hashlib
import io
import math
import random
import time
import zipfile
from collections import Counter

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus import awkward, docs
from punctual.llm import bpe, html, langid, warc
from punctual.llm.queries import held_out
from punctual.session import shared_path

RANKS = public.path("byte_bpe_50k.tiktoken")
ENCODING = tiktoken.Encoding(
    "own", pat_str=public.PATTERN, special_tokens={},
    mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))},
)
CODEC = bpe.Codec(RANKS, public.PATTERN)
ALPHABET = "ab \n\t\x1c\x85\xa0'sé漢字\U0001f600123٣½²ⅷ_-!?​́　  <|endoftext|>"


@given(st.lists(st.one_of(st.text(ALPHABET, max_size=60), st.text(max_size=30)), max_size=6))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_public_library(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    got = list(CODEC.encode(texts))
    assert got == [" ".join(map(str, ENCODING.encode_ordinary(t))) for t in texts]
    assert [CODEC.decode(g).decode() for g in got] == texts


def test_long_pieces_and_a_full_memory(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    rng = random.Random(3)
    texts = ["a" * 3000, "ab" * 2000, " " * 5000, "x" * 64, "x" * 65, "é" * 200]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (10, 63, 64, 65, 500)]
    own = bpe.Codec(RANKS, public.PATTERN)
    assert list(own.encode(texts)) == [" ".join(map(str, ENCODING.encode_ordinary(t))) for t in texts]


def test_short_and_long_pieces_merge_alike():
    rng = random.Random(4)
    pieces = [bytes(rng.choice(b"etaoin shr") for _ in range(rng.randrange(2, 17))) for _ in range(500)]
    assert bpe.merge_short(pieces, 16, CODEC.words) == [bpe.merge_long(p, CODEC.words) for p in pieces]


def test_merges_and_cuts_are_bounded_at_once(monkeypatch):
    sizes, cuts = [], []
    merge, own = bpe.merge_short, bpe.Codec(RANKS, public.PATTERN)
    monkeypatch.setattr(bpe, "merge_short", lambda pieces, leaves, words: sizes.append(len(pieces) * leaves) or merge(pieces, leaves, words))
    texts = [" ".join(f"{k:x}" * 9 for k in range(n, n + 2_000)) for n in range(5_000, 45_000, 2_000)]
    cut = own.pieces
    own.pieces = lambda text: cuts.append(len(text)) or cut(text)
    coded = own.encode(texts)
    first = next(coded)
    assert sum(cuts) <= 500_000 + max(map(len, texts)) < sum(map(len, texts))
    assert own.decode(first).decode() == texts[0]
    assert [own.decode(ids).decode() for ids in coded] == texts[1:]
    assert max(sizes) <= 1 << 18


def test_coded_rows(spark):
    rows = awkward()
    got = Counter(tuple(r) for r in bpe.coded(docs(spark, rows), RANKS, public.PATTERN).collect())
    want = Counter()
    for i, t, *_ in rows:
        ids = ENCODING.encode_ordinary(t or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (t or "").encode())]
        want[(i, len(ids), *sha)] += 1
    assert got == want
    with_ids = bpe.coded(docs(spark, rows[:2]), RANKS, public.PATTERN, ids=True).first()
    assert with_ids["token_ids"] == ENCODING.encode_ordinary(rows[0][1])
    assert bpe.coded(docs(spark, []), RANKS, public.PATTERN).count() == 0


def test_language_of_held_out_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(df.where(~held_out()))
    out = langid.predict(df.withColumn("held", held_out()), model).toPandas()
    test = out[out["held"]]
    assert len(test) > 20 and (test["lang"] == test["lang_pred"]).mean() > 0.95
    assert out["score"].between(0, 1).all() and out["rejected"].mean() < 0.02


def test_language_of_awkward_rows(spark, sf):
    model = langid.fit(spark.read.parquet(f"{sf}/documents.parquet"))
    df = docs(spark, [(1, None, "en", "a"), (2, "", None, None), (3, "12 !?", "en", None), (4, "漢字", "en", None), (5, "the of and", "fr", "x")])
    out = {r["doc_id"]: r for r in langid.predict(df, model).collect()}
    assert [out[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert all(out[i]["score"] == 0 and out[i]["rejected"] for i in (1, 2, 3))
    assert out[4]["lang_pred"] in {"en", "de", "fr", "es"} and out[5]["lang_pred"] == "en"
    assert out[1]["kept"] == "k"


def test_far_texts_are_rejected(spark):
    rng = random.Random(1)

    def text(letters, n):
        return " ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(n))

    rows = [(i, text("abcdef" if i % 2 else "nopqrs", 100), "xy"[i % 2], "a") for i in range(200)]
    model = langid.fit(docs(spark, rows))
    out = langid.predict(docs(spark, [(1, text("abcdef", 100), None, None), (2, text("uvwxyz", 100), None, None)]), model)
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in out.collect()}
    assert got[1] == ("y", False) and got[2][1]


def test_short_and_long_texts_have_a_floor(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.fit(df)
    assert (model.held.floor > 0).all()
    rng = random.Random(2)
    foreign = ["".join(rng.choice("абвгдежзиклмнопрст ") for _ in range(n)) for n in (20, 60, 300, 1_500, 60_000) for _ in range(5)]
    out = langid.predict(docs(spark, [(i, t, None, None) for i, t in enumerate(foreign)]), model).toPandas()
    assert out["rejected"].all()
    own = df.selectExpr("doc_id", "substr(text, 1, 20) as text").where("length(text) = 20 and text rlike '[a-z]{3}'")
    assert langid.predict(own, model).toPandas()["rejected"].mean() < 0.05


def test_any_number_of_languages(spark, sf, monkeypatch):
    """Centroids that are read in blocks from the shared folder say the same as those held at once."""
    df = spark.read.parquet(f"{sf}/documents.parquet")
    odd = docs(spark, [(1, None, None, None), (2, "1 2", None, None), (3, "где мы", None, None)], clashing=False)
    asked = df.select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    columns = ["doc_id", "lang_pred", "rejected", "score"]
    held = langid.fit(df)
    want = sorted(map(tuple, langid.predict(asked, held).select(columns).collect()))
    monkeypatch.setattr(langid, "AT_ONCE", 1)
    blocks = langid.fit(df)
    assert blocks.held is None and len(blocks.files) > 1
    assert sorted(lang for b in blocks.blocks() for lang in set(b.language)) == sorted(set(held.held.language))
    got = sorted(map(tuple, langid.predict(asked, blocks).select(columns).collect()))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-6)


def test_rare_languages_are_learned(spark):
    """All of six hundred languages, also those of a single text."""
    rows = [(i, f"{chr(0x4E00 + i % 600) * 8} {chr(0x4E00 + i % 600) * 3}", f"l{i % 600}", "a") for i in range(700)]
    model = langid.fit(docs(spark, rows, clashing=False))
    out = langid.predict(docs(spark, rows, clashing=False), model).toPandas()
    assert model.held is None and (out["lang_pred"] == out["lang"]).mean() > 0.95


def test_predictions_equal_a_plain_search(spark, sf):
    """Weights, clusters, floors and the search written out with dictionaries and loops, over a small table."""
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").orderBy("doc_id").limit(60)
    model = langid.fit(texts)

    def vector(text):
        found = langid.counts(text)
        v = {c: math.log1p(n) * float(model.idf[c]) for c, n in enumerate(found) if n}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {c: x / size for c, x in v.items()}, int(found.sum())

    rows = texts.collect()
    df = {}
    for r in rows:
        for c in np.flatnonzero(langid.counts(r["text"])):
            df[c] = df.get(c, 0) + 1
    for c in (0, 7, 1000, 4095):
        assert model.idf[c] == pytest.approx(math.log((1 + len(rows)) / (1 + df.get(c, 0))) + 1, rel=1e-6)
    out = {r["doc_id"]: r for r in langid.predict(texts, model).collect()}
    for r in rows:
        v, long = vector(r["text"])
        near = [sum(x * float(centre[c]) for c, x in v.items()) for centre in model.held.centroids]
        best = max(range(len(near)), key=lambda i: near[i])
        got = out[r["doc_id"]]
        assert got["score"] == pytest.approx(near[best], abs=1e-5)
        assert got["lang_pred"] == model.held.language[best]
        assert got["rejected"] == (near[best] < model.held.floor[best][min(31, int(math.log2(long)))])


def test_nothing_to_learn_from(spark):
    df = docs(spark, [(1, "some words", None, "a"), (2, None, "en", "a")])
    model = langid.fit(df)
    assert model is None
    assert [r["lang_pred"] for r in langid.predict(df, model).collect()] == ["und", "und"]
    assert langid.fit(docs(spark, [])) is None


def page(i, body, host="h.example"):
    top = f"<!DOCTYPE html><html><head><title>t{i}</title><style>p>a{{}}</style></head><body>"
    menu = f"<header><a href='/'>Home</a></header><ul class='main-menu'><li><a href=x>Item {i}</a></li></ul>"
    end = "<div class=side-bar><p>About us</p></div><footer>&copy; all</footer></body></html>"
    return (i, f"https://{host}/p/{i}", f"{top}{menu}{body}{end}")


PAGES = [
    page(i, f"<div id=content><p>Text &amp; number {i}\n  of <b>many</b><script>var x='</p>'</script> words here.<p>Second &lt;{i}&gt;</div>"
            f"<p class=share>Follow us</p><div class='comments'><p>Comment {i} is not the text, however long it may be made.</p></div>")
    for i in range(6)
]


def texts_of(spark, rows, kinds="page_id long, url string, html string"):
    return {r["id"]: r["text"] for r in html.extract(spark.createDataFrame(rows, kinds)).collect()}


def test_slots_of_a_template(spark):
    got = texts_of(spark, PAGES)
    assert got == {i: f"Text & number {i} of many words here.\nSecond <{i}>" for i in range(6)}


def test_fixed_strings_go_and_articles_stay(spark):
    rows = [page(i, f"<article><h1>Head {i}</h1><p>By the editors</p><p>Own words {i}</p><p>{'Shared' if i < 2 else 'Not'} {i // 2}</p>"
                    f"<aside>note {i}</aside></article><div class=ad>Buy {i}</div>") for i in range(6)]
    got = texts_of(spark, rows)
    assert got[0] == "Head 0\nOwn words 0\nShared 0" and got[1] == "Head 1\nOwn words 1\nShared 0"
    alone = texts_of(spark, rows[:1])
    assert alone[0] == "Head 0\nBy the editors\nOwn words 0\nShared 0"


@pytest.mark.parametrize("most", [10, 0])
def test_copies_are_no_template(spark, monkeypatch, most):
    monkeypatch.setattr(html, "BROADCAST_ROWS", most, raising=False)
    body = "<html><body><article id=post-7><h1>Head</h1><p>Own words</p></article></body></html>"
    rows = [(i, f"https://copies/{i}", body) for i in range(6)] + [(10 + i, None, body) for i in range(6)]
    rows += [(20 + i, f"https://mixed/{i}", body) for i in range(6)]
    other = "<html><body><article id=post-{0}><h1>Other {0}</h1><p>By us</p></article></body></html>"
    rows += [(30 + i, f"https://mixed/o{i}", other.format(i)) for i in range(4)]
    got = texts_of(spark, rows)
    assert all(got[i] == "Head\nOwn words" for i in got if i < 30)
    assert all(got[30 + i] == f"Other {i}\nBy us" for i in range(4))


ARTICLE = "<article><p>Own words</p></article>"


@pytest.mark.parametrize("page, want", [
    (f"<body><svg class='icon'/>{ARTICLE}", "Own words"),
    ("<body><p>a<svg><title/><path d=x></svg> b</p>", "a b"),
    (f"<body><svg class=icon><path d=x>{ARTICLE}", "Own words"),
    (f"<body><button>Menu{ARTICLE}<button>Share</button>", "Own words"),
    (f"<body><div><button>Menu</div>{ARTICLE}<button>Share</button>", "Own words"),
    (f"<body><object data=x>{ARTICLE}<p>", "Own words"),
    (f"<head><title>t</title><meta charset=x>{ARTICLE}", "Own words"),
    ("<head><link rel=x><title>t</title><p>Own words", "Own words"),
    ("<body><p>a</p><svg><svg>x</svg><text>y</text></svg><p>b</p>", "a\nb"),
    ("<body><p>a</p><object><object>x</object><p>y</p></object><template><template>x</template>z</template><p>b</p>", "a\nb"),
    ("<body><svg><foreignObject><div><p>x</p></div></foreignObject></svg><p>b</p>", "b"),
    ("<body><select><option>x<option>y</select><p>b</p><script>never closed <p>x", "b"),
])
def test_hidden_elements_end(page, want):
    assert html.main_text(page, set(), set()) == want


TEXT = "Own words that say much more than all that surrounds them."


@pytest.mark.parametrize("page", [
    f"<body class='no-sidebar'><article><p>{TEXT}</p></article>",
    f"<div class='content-sidebar-wrap'><article><p>{TEXT}</p></article></div>",
    f"<article class='post comments-open'><p>{TEXT}</p></article>",
    f"<article class='post teaser'><p>{TEXT}</p></article><div class=comments><p>Not this, be it as long as it may or even longer than that.</p></div>",
    f"<form><div class=widget><article><p>{TEXT}</p></article></div><div class=widget>Not this</div></form>",
    f"<form><nav><a href=x>Home</a></nav><p>{TEXT}</p></form>",
    f"<main><article><p>{TEXT}</p></article><div class=comments><p>{'Not this. ' * 15}</p></div></main>",
    f"<article><p>{TEXT}</p></article><footer>{'Not this. ' * 50}</footer>",
    f"<main><div class=notice><p>{TEXT}</p></div><p class=share>Not this</p></main>",
])
def test_hints_do_not_hide_the_article(page):
    assert html.main_text(page, set(), set()) == TEXT


def test_short_slots_of_the_article_stay(spark):
    body = "<div id=c><h1>Head {0}</h1><p class=lead>Lead {0}</p><div class=body>{1}</div><div class=end>End {0}</div></div>"
    rows = [page(i, body.format(i, "".join(f"<p>Own words {i} {k} that fill the page.</p>" for k in range(2 + i)))) for i in range(6)]
    got = texts_of(spark, rows)
    for i in range(6):
        own = [f"Own words {i} {k} that fill the page." for k in range(2 + i)]
        assert got[i] == "\n".join([f"Head {i}", f"Lead {i}", *own, f"End {i}"])


@pytest.mark.parametrize("text, want", [
    (f"<div class=x><p>{TEXT}</p></div><article>Card</article>", f"{TEXT}\nCard"),
    (f"<div class=x><p>Aside</p></div><article><p>{TEXT}</p></article>", TEXT),
    ("<p><a href=x>Only links</a></p>", ""),
])
def test_articles_are_weighed(text, want):
    assert html.main_text(text, set(), set()) == want


def test_awkward_pages(spark):
    rows = [
        (1, None, None), (2, "u", ""), (None, None, "plain text"), (4, "https://x/", "<article><p>cut off <b>here"),
        (5, "https://x/", "<p>a &nbsp; b<!-- <p>no</p> --><p>1 < 2"), (6, "https://x/", "<article><p>cut off <b>here"),
        (7, "https://y/", "<script>never closed <p>x"), (8, "https://y/", "<article>" + "<p>w</p>" * 5000 + "</article>"), (9, "z", "<p a='x"),
    ]
    got = texts_of(spark, [(*r, "c", "t") for r in rows], "page_id long, url string, html string, host string, tags string")
    assert got == {1: "", 2: "", None: "plain text", 4: "cut off here", 5: "a b\n1 < 2", 6: "cut off here", 7: "", 8: "\n".join(["w"] * 5000), 9: ""}
    assert texts_of(spark, []) == {}


def test_vectors_tell_classes_apart(spark):
    found = {r["host"]: r for r in html.templates(spark.createDataFrame(
        [(i, u, h) for i, (_, u, h) in enumerate(PAGES)], "page_no long, url string, html string")).collect()}
    assert set(found) == {"h.example"}
    held = Counter(type(x).__name__ for x in html.parse(PAGES[0][2]) if x.token in set(found["h.example"]["tags"] + found["h.example"]["strings"]))
    assert held["Tag"] >= 8 and held["Block"] >= 2


def archive_rows():
    rows = [(i, f"https://h/{i}", f"<p>{i % 4}</p>" * (1 + i % 4)) for i in range(40)]
    rows += [(50, None, None), (51, "u\r\nx", ""), (52, "u", ""), (53, "é", "é\r\n\r\n\U0001f600"), (7, "https://h/7", "<p>3</p>" * 4)]
    return rows + [(None, "n", "<p>0</p>"), (None, "n", "only"), (None, "n", "only"), (2**60 + 1, "big", "big"), (60, "z", "x" * 300_000)]


def brute_records(rows):
    least = {}
    for i, _, h in rows:
        key = (i is None, i or 0)
        least[h or ""] = min(least.get(h or "", key), key)
    out, led = Counter(), set()
    for i, _, h in rows:
        raw = (h or "").encode()
        lead = least[h or ""] == (i is None, i or 0) and h not in led and (h or "") not in led
        if lead:
            led.add(h or "")
        first = None if least[h or ""][0] else least[h or ""][1]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out[i, len(raw), digest, "response" if lead else "revisit", None if lead else first] += 1
    return out


def test_archives_give_back_what_was_written(spark):
    rows = archive_rows()
    df = spark.createDataFrame([(*r, "d", "t", 1) for r in rows], "page_id long, url string, html string, digest string, path string, twins int")
    got = Counter(tuple(r) for r in warc.archived(df.repartition(3)).select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == brute_records(rows)
    manifest = warc.write_archives(warc.classified(df), shared_path(spark, "warc"), archive_bytes=2000)
    assert manifest.count() > 3
    back = warc.read_archives(manifest)
    assert Counter(r["payload"].decode() for r in back.where("record_type = 'response'").collect()) == Counter({h or "" for _, _, h in rows})
    assert warc.archived(df.limit(0)).count() == 0


def test_foreign_archives_are_read(tmp_path):
    small, wide = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(small, "w") as z:
        z.writestr("a.txt", "stored")
        z.writestr("packed", "deflated", compress_type=zipfile.ZIP_DEFLATED)
        z.comment = b"PK\5\6 in a comment"
    with zipfile.ZipFile(wide, "w") as z:
        for i in range(66_000):  # more than the plain end record can count
            z.writestr(str(i), b"" if i < 65_999 else b"last")
    for data, name, want in ((small, "a.txt", b"stored"), (wide, "65999", b"last")):
        size = data.getbuffer().nbytes
        held = warc.members(data, size)
        assert "packed" not in held
        header, length = held[name]
        assert warc.read_range(data, warc.data_start(data, header), length) == want
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.members(io.BytesIO(b"no archive"), 10)


def test_damage_is_noticed():
    data = warc.record(1, "u", b"payload", hashlib.sha1(b"payload").digest(), "response", None, 0)
    assert warc.parsed(data)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.parsed(data.replace(b"payload\r\n", b"paYload\r\n"))


@pytest.mark.parametrize("piece", [
    "<div>x</span2></y>", "<svg><g>", "<object><div></q>", "<select><option>a</p>", "<div id=a>w ", "<button>a<select>b</select>", "<svg><desc><div>",
])
def test_parsing_time_grows_with_the_page_alone(piece):
    """What is never closed, or never opened, costs no search through all that is open."""
    start = time.perf_counter()
    html.main_text(piece * (1_000_000 // len(piece)), set(), set())
    assert time.perf_counter() - start < 30
