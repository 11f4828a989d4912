"""Methods whose results SQL cannot state, written out plainly: template deduction, randomness tests and their bars."""

import math
import random
from collections import Counter, defaultdict

import pytest

from punctual.llm import html, secrets

SF = "/root/testdata/sf0.001"


# templates


def _templates(rows, least_pages=html.LEAST_PAGES, least_share=html.LEAST_SHARE):
    """Per host the tags and strings of its template, from explicit vectors with one count per different page."""
    hosts = defaultdict(list)
    for _, url, page in rows:
        payload = page or ""
        if payload not in hosts[html.host_of(url)]:
            hosts[html.host_of(url)].append(payload)
    out = {}
    for host, payloads in hosts.items():
        vectors, about = defaultdict(lambda: [0] * len(payloads)), {}
        for i, payload in enumerate(payloads):
            for x in html.parse(payload):
                vectors[x.token][i] += 1
                about[x.token] = (x.parent, isinstance(x, html.Tag))
        on = {t: sum(n > 0 for n in v) for t, v in vectors.items()}
        most = max(on.values(), default=0)
        often = {t for t in vectors if on[t] >= least_pages and on[t] >= most * least_share}
        classes = defaultdict(list)
        for t in often:
            classes[tuple(vectors[t])].append(t)
        valid = {t for members in classes.values() if sum(about[t][1] for t in members) >= 2 for t in members}

        def nests(token):
            around = about[token][0]
            while around and around not in valid:
                if around not in often:
                    return False
                around = about[around][0]
            return not around or (on[around] >= on[token] and nests(around))

        kept = {t for t in valid if nests(t)}
        if kept:
            out[host] = ({t for t in kept if about[t][1]}, {t for t in kept if not about[t][1]})
    return out


def _found(spark, rows):
    df = spark.createDataFrame(rows, "page_no long, url string, html string")
    return {r["host"]: (set(r["tags"]), set(r["strings"])) for r in html.templates(df).collect()}


def test_templates_equal_explicit_vectors(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    want = _templates(rows)
    assert want and _found(spark, rows) == want


@pytest.mark.parametrize("seed", range(3))
def test_templates_of_random_pages_equal_explicit_vectors(spark, seed):
    rng = random.Random(seed)
    frames = [f"<div id=f{k}><p>fixed {k}</p>{{}}</div>" for k in range(6)]
    rows = []
    for i in range(60):
        parts = [f.format("".join(f"<p>free {rng.randrange(30)}</p>" for _ in range(rng.randrange(3)))) for f in frames if rng.random() < 0.8]
        if rng.random() < 0.2:
            rng.shuffle(parts)
        rows.append((i, f"http://h{rng.randrange(3)}.example/{i}", "<body>" + "".join(parts) + rng.choice(["", "<hr>", "<table><tr><td>x</table>"])))
    rows += [(100 + i, rows[i % 4][1], rows[i % 4][2]) for i in range(20)] + [(200, None, None), (201, "http://h0.example/z", "")]
    assert _found(spark, rows) == _templates(rows)


# randomness tests


def _tail(z):
    return math.erfc(abs(z) / math.sqrt(2))


def _battery(token):
    name, alphabet = next((k, a) for k, a in secrets.ENCODINGS.items() if k == "base64" or set(token) <= set(a))
    n, a = len(token), len(alphabet)
    codes = [alphabet.find(c) for c in token]
    squares = sum(c * c for c in Counter(codes).values())
    z_chi = max(0.0, (a / n * squares - n - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n))
    sides = [c >= a / 2 for c in codes]
    high, turns = sum(sides), 1 + sum(x != y for x, y in zip(sides, sides[1:]))
    mean = 2 * high * (n - high) / n + 1
    z_runs = (turns - mean) / math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 0.25))
    z_side = (high - n / 2) / math.sqrt(n / 4)
    middle = (a - 1) / 2
    lagged = sum((x - middle) * (y - middle) for x, y in zip(codes, codes[1:]))
    z_lag = lagged / ((a * a - 1) / 12) / math.sqrt(n - 1)
    z_share = 0.0
    for letters in (secrets.LOWER, secrets.UPPER, secrets.DIGITS):
        part = sum(c in letters for c in alphabet) / a
        if 0 < part < 1:
            held = sum(c in letters for c in token)
            z_share = max(z_share, abs(held - n * part) / math.sqrt(n * part * (1 - part)))
    p = min(1.0, 3 * min(_tail(max(z_chi, z_share)), min(_tail(z_runs), _tail(z_side)), _tail(z_lag)))
    return name, n, p


def _tokens(seed=1):
    rng = random.Random(seed)
    out = ["a" * 20, "ab" * 30, "0123456789" * 4, "abcdefghijklmnopqrstuvwxyz", "A" * 5_000, "".join(rng.choices(secrets.ENCODINGS["base64"], k=20_000))]
    for alphabet in secrets.ENCODINGS.values():
        out += ["".join(rng.choices(alphabet, k=n)) for n in (20, 21, 40, 64, 129) for _ in range(30)]
    out += ["-".join(rng.choices(["word", "other", "thing", "Name"], k=6)) for _ in range(40)]
    return out


def test_battery_equals_plain_statistics(spark):
    tokens = _tokens()
    got = {r["no"]: r for r in secrets.battery(spark.createDataFrame(list(enumerate(tokens)), "no int, token string")).collect()}
    for i, token in enumerate(tokens):
        name, n, p = _battery(token)
        assert (got[i]["encoding"], got[i]["long"]) == (name, n)
        assert got[i]["p"] == pytest.approx(p, abs=2e-6)


def test_bars_equal_counts_by_hand(spark):
    """The least bin of p at which the estimated false share of an encoding and length is still small enough."""
    tokens = _tokens(2)
    tested = secrets.battery(spark.createDataFrame([(t,) for t in tokens], "token string"))
    tested = spark.createDataFrame(tested.select("token", "encoding", "long", "p").collect())  # as ``scan`` does, written first
    rows = [(r["token"], r["encoding"], int(math.log2(r["long"])), int(min(r["p"], 0.999999) * secrets.BINS)) for r in tested.collect()]
    want = []
    for cell in {r[1:3] for r in rows}:
        bins = [r[3] for r in rows if r[1:3] == cell]
        drawn = sum(b >= secrets.ORDINARY * secrets.BINS for b in bins) / (1 - secrets.ORDINARY)
        good = []
        for t in sorted(set(bins)):
            n = sum(b >= t for b in bins)
            if t >= 1 and n - drawn * (1 - t / secrets.BINS) <= n * secrets.FALSE_SHARE:
                good.append(t)
        if good:
            want += [r[0] for r in rows if r[1:3] == cell and r[3] >= min(good)]
    assert sorted(r["token"] for r in secrets.accepted(tested).collect()) == sorted(want) and want
