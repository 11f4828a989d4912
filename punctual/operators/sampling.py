"""Exact, repeatable samples of any size.

Rows are ordered by a keyed hash of their id (or by time), and a sample is "everything up to
a cutoff". The cutoff is found by counting cells: the cell it falls in is known exactly, and
only that cell is ranked. No step sorts the table or gathers a stratum in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.operators.lookup import attach, estimated_bytes, size_metrics
from punctual.session import settle, settle_observed

# Above this many rows a cell is divided again before its rows are ranked.
ROWS_PER_CELL = 500_000
# How often a row is repeated at once.
REPEATS = 10_000
# How many leading hex digits of the hash make up each level of cells.
DIGITS = (3, 6, 9)


def shuffle_key(row_id: str, seed: int) -> Column:
    """A repeatable random order over ids that other engines can reproduce."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(row_id).cast("string")).cast("binary"))


def _hashed(df: DataFrame, row_id: str, seed: int) -> DataFrame:
    keyed = df.withColumn("_key", shuffle_key(row_id, seed))
    return keyed.withColumns({f"_cell{n}": F.substring("_key", 1, n) for n in DIGITS})


_HASH_LEVELS = [f"_cell{n}" for n in DIGITS]


def _cutoffs(
    ordered: DataFrame,
    strata: list[str],
    order: list[str],
    levels: list[str],
    quota: Callable[[Column, Column], Column],
    rows_per_cell: int,
) -> DataFrame:
    """Per stratum, the last row (by ``order``) that still belongs to the sample.

    Each entry of ``levels`` is a column that never decreases along ``order`` among the rows
    that agree on the levels before it. Counting per level narrows the search to one cell per
    stratum, until those cells are small enough to rank. ``quota`` maps (rows in the stratum,
    rows in total) to the number of rows wanted.
    """
    within = Window.partitionBy(*strata)
    inside = ordered
    for depth, level in enumerate(levels):
        known = ["_left"] if depth else []
        counts = settle(inside.groupBy(*strata, level, *known).agg(F.count(F.lit(1)).alias("_c")))
        running = within.orderBy(level).rowsBetween(Window.unboundedPreceding, 0)
        sized = counts.withColumn("_upto", F.sum("_c").over(running))
        if not known:
            total = counts.agg(F.sum("_c").alias("n")).scalar()
            sized = sized.withColumn("_size", F.sum("_c").over(within))
            sized = sized.withColumn("_left", F.least(quota(F.col("_size"), total).cast("long"), F.col("_size")))
        before = F.col("_upto") - F.col("_c")
        edges = sized.filter((before < F.col("_left")) & (F.col("_left") <= F.col("_upto"))).select(
            *strata, F.col(level).alias("_edge"), (F.col("_left") - before).alias("_left"), "_c"
        )
        edges, seen = settle_observed(edges, {**size_metrics(edges), "_most": F.max("_c")})
        narrowed = attach(
            inside.drop("_left"), edges.drop("_c"), strata, "inner", size=estimated_bytes(edges, seen), null_safe=True
        )
        inside = narrowed.filter(F.col(level) == F.col("_edge")).drop("_edge")
        if (seen["_most"] or 0) <= rows_per_cell:
            break
    rank = F.row_number().over(within.orderBy(*order))
    last = inside.withColumn("_rank", rank).filter(F.col("_rank") == F.col("_left"))
    return last.select(*strata, F.struct(*order).alias("_last"))


def _take(
    ordered: DataFrame,
    strata: list[str],
    order: list[str],
    levels: list[str],
    quota: Callable[[Column, Column], Column],
    columns: list[str],
    mark: str | None,
    rows_per_cell: int,
) -> DataFrame:
    narrow = ordered.select(*dict.fromkeys([*strata, *order, *levels]))
    cutoffs = _cutoffs(narrow, strata, order, levels, quota, rows_per_cell)
    here = F.struct(*order)
    if mark is None:
        return attach(ordered, cutoffs, strata, "inner", null_safe=True).filter(here <= F.col("_last")).select(*columns)
    joined = attach(ordered, cutoffs, strata, "left", null_safe=True)
    return joined.withColumn(mark, F.coalesce(here <= F.col("_last"), F.lit(False))).select(*columns, mark)


def take_by_hash(
    df: DataFrame,
    row_id: str,
    quota: Callable[[Column, Column], Column],
    *,
    strata: list[str] | None = None,
    seed: int = 2026,
    mark: str | None = None,
    rows_per_cell: int = ROWS_PER_CELL,
) -> DataFrame:
    """From each stratum exactly ``quota(stratum rows, all rows)`` rows, chosen by hash order.

    With ``mark`` all rows are kept and the chosen ones are flagged in that column.
    ``row_id`` must be unique.
    """
    keyed = _hashed(df, row_id, seed)
    groups = list(strata or [])
    if not groups:
        keyed, groups = keyed.withColumn("_all", F.lit(0)), ["_all"]
    return _take(keyed, groups, ["_key", row_id], _HASH_LEVELS, quota, df.columns, mark, rows_per_cell)


def simple_random(df: DataFrame, n: int, row_id: str, *, seed: int = 2026, **options) -> DataFrame:
    """Exactly ``n`` rows (or all, if there are fewer)."""
    return take_by_hash(df, row_id, lambda size, total: F.lit(n), seed=seed, **options)


def stratified(df: DataFrame, n: int, row_id: str, strata: list[str], *, seed: int = 2026, **options) -> DataFrame:
    """About ``n`` rows: every stratum keeps its share, rounded, and at least one row."""
    def share(size: Column, total: Column) -> Column:
        return F.greatest(F.lit(1.0), F.bround(size * (F.lit(float(n)) / total)))

    return take_by_hash(df, row_id, share, strata=strata, seed=seed, **options)


def shuffled_split(df: DataFrame, row_id: str, *, fraction: float = 0.8, seed: int = 2026, **options) -> DataFrame:
    """Exact shuffled split: ``int(fraction * rows)`` rows get ``in_train``."""
    return take_by_hash(
        df, row_id, lambda size, total: F.floor(total * F.lit(fraction)), seed=seed, mark="in_train", **options
    )


def convenience(
    df: DataFrame, n: int, ts: str, row_id: str, *, seed: int = 0, rows_per_cell: int = ROWS_PER_CELL
) -> DataFrame:
    """The first ``n`` rows by time; rows of the very same time follow in hash order.

    Narrowed by minute, then exact time, then hash, so neither a crowded minute nor a crowded
    instant has to be ranked as a whole.
    """
    minute = F.timestamp_diff("MINUTE", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    ordered = _hashed(df, row_id, seed).withColumns({"_minute": minute, "_all": F.lit(0)})
    order, levels = [ts, "_key", row_id], ["_minute", ts, *_HASH_LEVELS]
    return _take(ordered, ["_all"], order, levels, lambda size, total: F.lit(n), df.columns, None, rows_per_cell)


def undersample(df: DataFrame, row_id: str, label: str, *, per_rare: float = 1.0, seed: int = 2026) -> DataFrame:
    """All rows of the rarest class; of every other class ``per_rare`` times as many, at most all."""
    rarest = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n").alias("n")).scalar()
    return take_by_hash(
        df,
        row_id,
        lambda size, total: F.when(size == rarest, size).otherwise(F.floor(rarest * F.lit(float(per_rare)))),
        strata=[label],
        seed=seed,
    )


def oversample(df: DataFrame, label: str) -> DataFrame:
    """Repeat each row of a class ``floor(largest class / its class)`` times. Train rows only.

    A row is repeated in two steps, so that no row holds an array longer than ``REPEATS`` or the
    number of such arrays, however rare its class is.
    """
    counts = settle(df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    largest = counts.agg(F.max("_n").alias("n")).scalar()
    times = counts.select(label, F.floor(largest / F.col("_n")).cast("long").alias("_times"))
    repeated = attach(df, times, label, "inner", null_safe=True)
    starts = F.expr(f"sequence(0L, _times - 1, {REPEATS}L)")
    repeated = repeated.withColumn("_start", F.explode(starts))
    copies = F.expr(f"sequence(1L, least({REPEATS}L, _times - _start))")
    return repeated.withColumn("_copy", F.explode(copies)).drop("_times", "_start", "_copy")


def stratum_shares(population: DataFrame, sample: DataFrame, column: str) -> DataFrame:
    """Share of each value in the population and in the sample."""
    counts = [
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).withColumn("of", F.lit(name))
        for name, df in (("population", population), ("sample", sample))
    ]
    both = settle(counts[0].unionByName(counts[1]))
    totals = {
        name: both.filter(F.col("of") == name).agg(F.sum("n").alias("n")).scalar() for name in ("population", "sample")
    }
    return both.groupBy(column).agg(
        *[
            (F.sum(F.when(F.col("of") == name, F.col("n")).otherwise(0)) / totals[name]).alias(f"{name}_share")
            for name in totals
        ]
    )


def borderline_sheet(
    df: DataFrame, row_id: str, a: str, b: str, columns: list[str], *, band: float = 6, n: int = 20, seed: int = 8
) -> DataFrame:
    """``n`` rows whose two values lie within ``band``, with an empty answer column for a reviewer."""
    near = df.filter(F.abs(F.col(a) - F.col(b)) <= band).withColumn("_key", shuffle_key(row_id, seed))
    return near.orderBy("_key", row_id).limit(n).select(*columns).withColumn("acceptable", F.lit(""))


def class_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Balanced weight per class: rows / (classes x rows of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    counts, seen = settle_observed(counts, {"rows": F.sum("n"), "classes": F.count(F.lit(1))})
    return counts.withColumn(name, F.lit(seen["rows"]).cast("double") / (F.lit(seen["classes"]) * F.col("n")))


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    return attach(df, class_weights(df, label, name).select(label, name), label, null_safe=True)
