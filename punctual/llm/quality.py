"""Quality rules: measures of one text, and lines that many documents of a host repeat.

Everything is a DataFrame expression. A text is read once; what later steps need of it is a hash and
a word count per line. A line's frequency is the number of documents of the host that hold it, each
document counting once, so it is a plain sum that tasks add up before they shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import BLANKS, broadcast_if_small, text_or_empty, written

WINDOW = 5
#: A line is removed if more documents of its host hold it than both of these allow.
MIN_DOCS, SHARE_OF_HOST = 10, 0.002
#: A document is depleted if less than this share of its words is left.
LEAST_LEFT = 0.5


def _repeat_words(hashes: str) -> list[tuple[str, Column]]:
    """Steps that count the words in windows whose hash occurs twice or more in the array."""
    n = F.size(hashes)
    repeats = F.size(F.array_distinct(hashes)) < n
    pairs = F.when(repeats, F.sort_array(F.arrays_zip(F.col(hashes).alias("h"), F.sequence(F.lit(0), n - 1).alias("i"))))
    same = F.expr(
        "filter(by_hash, (x, j) -> (j > 0 and by_hash[j - 1].h = x.h)"
        " or (j + 1 < size(by_hash) and by_hash[j + 1].h = x.h))"
    )
    covered = F.expr(
        f"aggregate(sort_array(transform(twins, x -> x.i)), named_struct('upto', 0, 'n', 0L),"
        f" (s, p) -> named_struct('upto', p + {WINDOW}, 'n', s.n + p + {WINDOW} - greatest(p, s.upto)), s -> s.n)"
    )
    return [("by_hash", pairs), ("twins", same), ("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))]


def measured(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """Per row: id, host, the base measures, and ``lines`` with hash and words of each line with a word."""
    words = F.expr(f"filter(split(text, '[{BLANKS}]+'), w -> w <> '')".replace("\\", "\\\\"))
    windows = F.expr(
        f"if(size(words) < {WINDOW}, cast(array() as array<bigint>),"
        f" transform(sequence(1, size(words) - {WINDOW - 1}), i -> xxhash64(slice(words, i, {WINDOW}))))"
    )
    lines = F.expr(f"filter(split(text, '\\n'), l -> l rlike '[^{BLANKS}]')".replace("\\", "\\\\"))
    normal = f"lower(trim(regexp_replace(l, '[{BLANKS}]+', ' ')))".replace("\\", "\\\\")
    hashed = F.expr(
        f"transform(lines, l -> named_struct('h', xxhash64({normal}), 'w', size(split({normal}, ' '))))"
    )
    df = docs.select(F.col(id_col).alias("id"), F.col(host_col).alias("host"), text_or_empty(text_col).alias("text"))
    df = df.withColumn("words", words).withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.expr("aggregate(words, 0L, (n, w) -> n + length(w))"),
        "n_symbols": F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long"),
        "windows": windows,
        "lines": lines,
    }).drop("text", "words")
    df = df.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"))
    df = df.withColumn("lines", hashed)
    for name, step in _repeat_words("windows"):
        df = df.withColumn(name, step)
    return df.drop("windows", "by_hash", "twins")


def frequent_lines(rows: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE_OF_HOST) -> DataFrame:
    """(host, h, n_docs): lines above the limit of their host, from ``measured`` rows."""
    held = rows.select("host", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
    often = held.groupBy("host", "h").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
    hosts = rows.groupBy("host").agg(F.count("*").alias("docs")).withColumnRenamed("host", "of_host")
    return (
        often.join(hosts, F.col("host").eqNullSafe(F.col("of_host")))
        .where(F.col("n_docs") > F.col("docs") * share)
        .select("host", "h", "n_docs")
    )


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE_OF_HOST, least_left: float = LEAST_LEFT,
) -> DataFrame:
    """One row per row of ``docs``: id, the base measures, base_failed, n_removed_words and kept.

    Words are runs of other characters than ASCII white space. Lines are compared in lower case with
    each run of white space as one space. A document fails the base with under 10 words or with over
    a fifth of its words in repeated 5-word windows; otherwise it is rejected if the lines above the
    limit leave less than ``least_left`` of its words. A null text is empty, a null host is a host of
    its own, repeated rows are documents of their own.
    """
    rows = measured(docs, id_col, text_col, host_col).withColumn("row_no", F.monotonically_increasing_id())
    rows = written(rows, "line_hashes")
    often = written(frequent_lines(rows, min_docs, share), "frequent_lines")
    known = often.select(F.col("host").alias("of_host"), "h", F.lit(True).alias("often"))
    lines = rows.select("row_no", "host", F.explode("lines").alias("line")).select("row_no", "host", "line.h", "line.w")
    known = broadcast_if_small(known.withColumnRenamed("h", "of_h"), often.count())
    hit = lines.join(known, F.col("host").eqNullSafe(F.col("of_host")) & (F.col("h") == F.col("of_h")))
    removed = hit.groupBy("row_no").agg(F.sum("w").alias("n_removed_words"))
    judged = rows.drop("lines").join(removed, "row_no", "left")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    gone = F.coalesce("n_removed_words", F.lit(0).cast("long"))
    left = (F.col("n_words") - gone) >= F.col("n_words") * least_left
    return judged.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & left).alias("kept"), gone.alias("n_removed_words"),
    )


def without_frequent_lines(
    docs: DataFrame, text_col: str = "text", host_col: str = "source",
    min_docs: int = MIN_DOCS, share: float = SHARE_OF_HOST,
) -> DataFrame:
    """``docs`` with the lines above the limits taken out of the text; all other columns as they were.

    Limits are as in ``judge``. A null text stays null.
    """
    rows = written(measured(docs, host_col, text_col, host_col), "line_hashes")
    often = written(frequent_lines(rows, min_docs, share), "frequent_lines")
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(host_col).alias("host"), F.col(text_col).alias("text"),
    )
    packed = written(packed.withColumn("row_no", F.monotonically_increasing_id()), "numbered_texts")
    line = F.posexplode(F.split("text", "\n", -1)).alias("at", "line")
    lines = packed.select("row_no", "host", line)
    normal = F.lower(F.trim(F.regexp_replace("line", f"[{BLANKS}]+", " ")))
    known = broadcast_if_small(often.select(F.col("host").alias("of_host"), F.col("h").alias("of_h")), often.count())
    hit = F.col("host").eqNullSafe(F.col("of_host")) & (F.xxhash64(normal) == F.col("of_h"))
    left = lines.join(known, hit, "left_anti").groupBy("row_no").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias("kept_text")
    )
    text = F.when(F.col("text").isNotNull(), F.coalesce("kept_text", F.lit("")))
    out = packed.join(left, "row_no", "left").select("row", text.alias("new_text"))
    return out.select(*[F.col("new_text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
