"""Secret scans: known shapes, and a battery of randomness tests for the rest.

Long tokens are candidates. The encoding is inferred from the characters in use, and three tests ask
whether the token could be drawn at random from that alphabet: chi-squared on the letter counts,
the number of runs above and below the middle, and the correlation of neighbours. Ordinary words
get p near 0, random tokens any p alike. So the number of tokens with p above ``ORDINARY`` tells how many
random ones there are of an encoding and length, and how many of those accepted are false; the
bar is set per encoding and length such that this share stays below ``FALSE_SHARE``.
Everything is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import text_or_empty, written

#: The base patterns, in the order in which spans that start together are listed.
KINDS = {
    "assign": r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{32,}",
}
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
#: Encodings from narrow to wide: the characters in order of their code.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + UPPER,
    "base62": DIGITS + UPPER + LOWER,
    "base64": UPPER + LOWER + DIGITS + "+/-_",
}
FALSE_SHARE = 0.05
#: p is counted in so many bins; above this value hardly any ordinary token has its p.
BINS, ORDINARY = 20, 0.25


def _matches(kind: str, pattern: str) -> dict[str, Column]:
    """Lengths of matches and of the gaps before them; null where nothing matches."""
    text, some = F.col("text"), F.col("text").rlike(pattern)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else found
    entry = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), lambda g: F.length(g)).alias("gap"),
        F.transform(found, lambda m: F.length(m)).alias("long"),
        (value if kind == "random" else F.transform(value, lambda v: F.length(v))).alias("value"),
    )
    return {kind: F.when(some, entry)}


def _placed(rows: DataFrame, kind: str) -> DataFrame:
    """(row_no, start, end, value) of the matches of a kind, from gaps and lengths added up."""
    each = rows.where(F.col(kind).isNotNull()).select("row_no", F.posexplode(kind).alias("i", "m"))
    upto = Window.partitionBy("row_no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.coalesce("m.gap", F.lit(0)) + F.coalesce("m.long", F.lit(0))).over(upto)
    placed = each.select("row_no", "m.value", end.alias("end"), F.col("m.long").alias("long")).where("long is not null")
    return placed.select("row_no", (F.col("end") - F.col("long")).alias("start"), "end", "value")


def _tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, by a rational approximation good to 1e-7."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1 / (1 + 0.3275911 * x)
    terms = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)
    poly = sum((F.lit(c) * F.pow(t, F.lit(float(k))) for k, c in enumerate(terms, 1)), F.lit(0.0))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def battery(tokens: DataFrame) -> DataFrame:
    """``tokens`` (token, ...) with encoding, long and p, the chance of looking so little random.

    p is three times the least of the three tests' p-values, at most 1.
    """
    encoding, alphabet = F.lit("base64"), F.lit(ENCODINGS["base64"])
    for name, letters in reversed(list(ENCODINGS.items())[:-1]):
        fits = F.col("token").rlike(f"^[{letters}]+$")
        encoding, alphabet = F.when(fits, F.lit(name)).otherwise(encoding), F.when(fits, F.lit(letters)).otherwise(alphabet)
    df = tokens.withColumns({"encoding": encoding, "alphabet": alphabet, "long": F.length("token")})
    df = df.withColumn("codes", F.expr("transform(split(token, ''), c -> cast(instr(alphabet, c) - 1 as double))"))
    df = df.withColumns({
        "a": F.length("alphabet").cast("double"),
        "n": F.size("codes").cast("double"),
        "squares": F.expr("aggregate(array_distinct(codes), 0D, (s, c) -> s + pow(size(filter(codes, x -> x = c)), 2))"),
    })
    df = df.withColumn("sides", F.expr("transform(codes, c -> c >= a / 2)"))
    df = df.withColumns({
        "high": F.expr("cast(size(filter(sides, x -> x)) as double)"),
        # neighbours side by side, so that no step of a lambda looks at the whole token
        "turns": F.expr(
            "cast(size(filter(zip_with(slice(sides, 1, size(sides) - 1), slice(sides, 2, size(sides) - 1), (x, y) -> x <> y), z -> z)) + 1 as double)"
        ),
        "lagged": F.expr(
            "aggregate(zip_with(slice(codes, 1, size(codes) - 1), slice(codes, 2, size(codes) - 1),"
            " (x, y) -> (y - (a - 1) / 2) * (x - (a - 1) / 2)), 0D, (s, x) -> s + x)"
        ),
    })
    n, a, high = F.col("n"), F.col("a"), F.col("high")
    chi, df_chi = a / n * F.col("squares") - n, a - 1
    # the count of pairs of equal letters has this mean and variance for any length
    z_chi = F.greatest((chi - df_chi) / F.sqrt(2 * df_chi * (n - 1) / n), F.lit(0.0))
    low = n - high
    mean = 2 * high * low / n + 1
    z_runs = (F.col("turns") - mean) / F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(0.25)))
    z_side = (high - n / 2) / F.sqrt(n / 4)
    z_lag = F.col("lagged") / ((a * a - 1) / 12) / F.sqrt(n - 1)
    # a draw from the whole alphabet holds digits, small and capital letters in these shares
    shares = [F.col("a") * 0]
    for letters in (LOWER, UPPER, DIGITS):
        part = F.length(F.regexp_replace("alphabet", f"[^{letters}]", "")) / a
        held = F.length(F.regexp_replace("token", f"[^{letters}]", "")).cast("double")
        shares.append(F.when((part > 0) & (part < 1), F.pow(held - n * part, F.lit(2.0)) / (n * part * (1 - part))).otherwise(0.0))
    z_share = F.sqrt(F.greatest(*shares))
    runs = F.least(_tail(z_runs), _tail(z_side))
    p = F.least(F.lit(1.0), 3 * F.least(_tail(F.greatest(z_chi, z_share)), runs, _tail(z_lag)))
    return df.withColumn("p", p).drop("alphabet", "codes", "a", "n", "squares", "sides", "high", "turns", "lagged")


def accepted(tested: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """Rows of ``tested`` (encoding, long, p, ...) above the bar of their encoding and length.

    Lengths are taken in powers of two. The tokens above ``ORDINARY``, scaled up by the
    share of random tokens there, estimate the random ones; with n tokens at or above p = t,
    n - random * (1 - t) of those n are false.
    """
    df = tested.withColumns({"size": F.floor(F.log2("long")), "bin": F.floor(F.least("p", F.lit(0.999999)) * BINS)})
    cells = df.groupBy("encoding", "size", "bin").agg(F.count("*").alias("c"))
    group = Window.partitionBy("encoding", "size")
    n = F.sum("c").over(group.orderBy(F.desc("bin")))
    upper = F.sum(F.when(F.col("bin") >= ORDINARY * BINS, F.col("c")).otherwise(0)).over(group) / (1 - ORDINARY)
    false = n - upper * (1 - F.col("bin") / BINS)
    bars = (
        cells.withColumns({"n": n, "false": false})
        .where((F.col("false") <= F.col("n") * false_share) & (F.col("bin") >= 1))
        .groupBy("encoding", "size").agg(F.min("bin").alias("bar"))
    )
    # one row per encoding and power of two of the length: a few hundred at most
    return df.join(F.broadcast(bars), ["encoding", "size"]).where("bin >= bar").drop("size", "bin", "bar")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """One row per row of ``docs``: id, found (array of kind, start, end), n_assign, n_access, n_hex.

    Positions count code points, the end is exclusive. ``found`` is in order of start, then of kind:
    assign, access, hex, random. Matches of a kind are leftmost and do not overlap; an assignment
    whose value has under 8 characters and an access key of under 16 are passed over. Null texts are
    empty; an empty text has no spans. Only texts with a match take part in a shuffle, as lengths.
    """
    df = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    found: dict[str, Column] = {}
    for kind, pattern in {**KINDS, "random": TOKEN}.items():
        found |= _matches(kind, pattern)
    rows = df.withColumns(found).drop("text").withColumn("row_no", F.monotonically_increasing_id())
    rows = written(rows, "matches")
    tokens = written(battery(_placed(rows, "random").withColumnRenamed("value", "token")), "tokens")
    spans = [
        _placed(rows, "assign").where("value >= 8"),
        _placed(rows, "access").where("value >= 16"),
        _placed(rows, "hex"),
        accepted(tokens, false_share),
    ]
    every = None
    for k, part in enumerate(spans):
        part = part.select("row_no", F.struct("start", F.lit(k).alias("k"), "end").alias("span"))
        every = part if every is None else every.unionByName(part)
    by_row = every.groupBy("row_no").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    names = F.array(*[F.lit(x) for x in [*KINDS, "random"]])
    named = F.transform(
        F.coalesce("spans", F.array().cast("array<struct<start:bigint,k:int,end:bigint>>")),
        lambda s: F.struct(F.get(names, s["k"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    out = rows.select("row_no", "id").join(by_row, "row_no", "left").select("id", named.alias("found"))
    counts = {f"n_{k}": F.expr(f"cast(size(filter(found, s -> s.kind = '{k}')) as bigint)") for k in KINDS}
    return out.withColumns(counts)


def listed(found: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
