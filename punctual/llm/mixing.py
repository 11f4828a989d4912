"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected target / size of the source times. The documents of a source
stand in one order (by size, then by a hash of the id), their expected copies are added up along it,
one random offset per source is added, and a document is emitted once for each integer that its
interval crosses. Standing in order of size makes the words taken come near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.llm.common import BLANKS, ranked, text_or_empty, written

#: Rows of one source and size that one window may hold on average.
ROWS_PER_CELL = 20_000


def word_count(text: str | Column) -> Column:
    """Number of runs of other characters than white space; null has none."""
    return F.regexp_count(text_or_empty(text), F.lit(f"[^{BLANKS}]+")).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2
) -> DataFrame:
    """(source, source_size, target) from ``sizes`` (source, size).

    The sources in order of code points, null last, have the weights in turn. They share
    ``share[0] / share[1]`` of all sizes; no target is above ``most`` times its source's size, and
    what is cut off goes to the others by weight until none is above. The water level rises from
    round to round and each round is one aggregation, so no task sees all sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = totals.withColumns({"no_source": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))})
    numbered = ranked(order, ["no_source", "name"], "sources").drop("no_source", "name")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = written(numbered.withColumn("weight", w).drop("rank"), "sources")
    cap = F.col("source_size") * most
    capped, level = -1, (0, 1)
    while True:
        full = (F.col("weight") * F.lit(float(level[0])) / F.lit(float(level[1]))) >= cap
        r = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap)).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
            F.count(F.when(full, 1)).alias("capped"),
        ).first()
        if not r["open"] or r["capped"] == capped:
            break
        capped = r["capped"]
        # the numerator in 1 / share[1] parts, so that it is a whole number
        level = (r["all"] * share[0] - (r["taken"] or 0) * share[1], r["open"] * share[1])
    even = F.col("weight") * F.lit(float(level[0])) / F.lit(float(level[1]))
    return sources.select("source", "source_size", F.least(cap.cast("double"), even).alias("target"))


def _planned(rows: DataFrame, narrow: DataFrame, seed: str, **rules) -> DataFrame:
    """``rows`` (id, source, size, ...) with source_size, target and copies. narrow: the same three, written."""
    cells = 1
    while cells * ROWS_PER_CELL < narrow.count():
        cells *= 16
    digits = len(f"{cells:x}") - 1
    place = {
        "no_source": F.col("source").isNull(),
        "name": F.coalesce("source", F.lit("")),
        "spot": F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")),
    }
    placed = rows.withColumns(place).withColumn("cell", F.substring("spot", 1, digits))
    small = narrow.withColumns(place).withColumn("cell", F.substring("spot", 1, digits))
    keys = ["no_source", "name", "size"]
    counts = small.groupBy(*keys, "cell").agg(F.count("*").alias("n"))
    by_size = counts.groupBy(*keys).agg(F.sum("n").alias("n_size"))
    before = Window.partitionBy("no_source", "name").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_size.withColumn("start", F.coalesce(F.sum("n_size").over(before), F.lit(0))).drop("n_size")
    before = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("cell_start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    targets = source_targets(narrow, **rules).withColumns(
        {"no_source": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))}
    ).drop("source")
    begin = (
        counts.join(starts, keys).join(targets, ["no_source", "name"])
        .withColumn("begin", F.col("start") + F.col("cell_start")).drop("start", "cell_start")
    )
    own = F.row_number().over(Window.partitionBy(*keys, "cell").orderBy("spot", "id"))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.col("name")).cast("binary")), 1, 8), 16, 10).cast("double") / 2.0**32
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    at = F.col("begin") + F.col("own")
    return (
        placed.withColumn("own", own)
        .join(begin, [*keys, "cell"])
        .withColumns({"expected": expected, "u": u, "at": at})
        # all documents of a source have the same expected copies: the sum is rank times it, exactly
        .withColumn("crossed", F.floor(F.expr("at * expected + u")) - F.floor(F.expr("(at - 1) * expected + u")))
        .withColumn("copies", F.least("crossed", F.ceil("expected")))  # where rounding adds one
    )


def mix_plan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **rules
) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies, taken.

    Null texts have size 0 and null is a source of its own. A source without words has target 0.
    Rows that share id and size are drawn like any others; which of them it is can not be told.
    The result depends on ids, sizes, sources and the seed only, not on the layout of the files.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"))
    rows = written(rows, "sizes")
    return _planned(rows, rows, seed, **rules).select(
        "id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix", **rules
) -> DataFrame:
    """The mix itself: each row of ``docs``, all columns, as often as the plan takes it."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"),
    )
    narrow = written(rows.drop("row"), "sizes")
    planned = _planned(rows, narrow, seed, **rules).where("copies > 0")
    return planned.select("row", F.explode(F.expr("sequence(1, cast(copies as int))"))).select("row.*")
