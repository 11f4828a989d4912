"""Exact, interpolated quantiles per group that never gather a large group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from punctual.operators.lookup import attach
from punctual.session import settle

ACCURACY = 10_000
# Groups of up to this many rows are left to Spark's own exact percentile, which holds a
# group's distinct values in one task.
DIRECT_ROWS = 100_000
# A bracket is cut into so many cells of equal width, whose rows are ranked on their own.
CELLS = 1000


def group_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probabilities: dict[str, float],
    *,
    accuracy: int = ACCURACY,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """One row per group with one column per entry of ``probabilities`` (name -> 0..1).

    The first pass counts the groups and takes approximate quantiles a little below and above
    each wanted one; the error of those is bounded, so each pair brackets the exact answer.
    Only the brackets of large groups are kept, and there are few large groups. The second
    pass keeps single values of a large group only inside its brackets and collapses what lies
    between two brackets to one count, so the running count that finds the exact ranks sees a
    tiny part of the group. Small groups need no brackets.
    """
    data = df.select(*keys, F.col(value).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    groups = list(keys)
    if not groups:
        data, groups = data.withColumn("_all", F.lit(0)), ["_all"]

    wanted = sorted(set(probabilities.values()))
    pad = 4.0 / accuracy
    points = [p for q in wanted for p in (max(0.0, q - pad), min(1.0, q + pad))]
    seen = Observation()
    summary = (
        data.groupBy(*groups)
        .agg(F.count("_v").alias("_n"), F.percentile_approx("_v", points, accuracy).alias("_b"))
        .observe(
            seen,
            F.count_if(F.col("_n") <= direct_rows).alias("small"),
            F.count_if(F.col("_n") > direct_rows).alias("large"),
        )
    )
    large = settle(summary.filter(F.col("_n") > direct_rows))
    parts = []
    if seen.get["small"] or not seen.get["large"]:
        rest = attach(data, large.select(*groups), groups, "left_anti", null_safe=True) if seen.get["large"] else data
        exact = [F.percentile("_v", F.lit(float(p))).alias(name) for name, p in probabilities.items()]
        parts.append(rest.groupBy(*groups).agg(*exact))
    if seen.get["large"]:
        parts.append(_bracketed(attach(data, large, groups, "inner", null_safe=True), groups, probabilities, wanted, accuracy))
    answer = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return answer.select(*keys, *probabilities)


def _bracketed(
    tagged: DataFrame, groups: list[str], probabilities: dict[str, float], wanted: list[float], accuracy: int
) -> DataFrame:
    """Exact quantiles of rows that carry their group's size ``_n`` and brackets ``_b``."""
    low = [F.col("_b")[2 * i] for i in range(len(wanted))]
    high = [F.col("_b")[2 * i + 1] for i in range(len(wanted))]
    # with fewer rows than this a bracket may be narrower than one rank
    inside = F.col("_n") <= accuracy
    anchor = F.lit(float("-inf"))
    for lo, hi in zip(low, high):
        inside = inside | F.col("_v").between(lo, hi)
        anchor = F.when(F.col("_v") > hi, hi).otherwise(anchor)
    # a cell never falls as values rise; several brackets have cells of their own, one after the other
    cell = F.lit(-1)
    for i, (lo, hi) in enumerate(zip(low, high)):
        part = F.coalesce(F.floor(F.try_divide(F.col("_v") - lo, hi - lo) * (CELLS - 1)), F.lit(0))
        last = F.when(hi > lo, CELLS - 1).otherwise(0)
        nth = F.when(F.col("_v") < lo, None).when(F.col("_v") <= hi, part).otherwise(last)
        first = F.col("_v") > high[i - 1] if i else F.lit(True)
        cell = F.when(first & nth.isNotNull(), i * CELLS + nth).otherwise(cell)
    cell = F.when(F.col("_n") <= accuracy, F.lit(0)).otherwise(cell).cast("int")
    collapsed = tagged.select(
        *groups, "_n", cell.alias("_cell"), F.when(inside, F.col("_v")).otherwise(anchor).alias("_v"),
        (~inside).alias("_gap"),
    )
    counts = settle(collapsed.groupBy(*groups, "_n", "_cell", "_v", "_gap").agg(F.count(F.lit(1)).alias("_c")))
    # ranks in two steps, cells of a group and values of a cell, so that no task sees a whole bracket
    cells = counts.groupBy(*groups, "_cell").agg(F.sum("_c").alias("_in_cell"))
    earlier = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_in_cell").over(earlier), F.lit(0))).drop("_in_cell")
    running = Window.partitionBy(*groups, "_cell").orderBy("_v", "_gap").rowsBetween(Window.unboundedPreceding, 0)
    placed = attach(counts, cells, [*groups, "_cell"], "inner", null_safe=True)
    ranked = placed.withColumn("_upto", F.col("_before") + F.sum("_c").over(running))

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("_upto") > rank, F.struct("_v", "_gap")))

    position = {p: (F.col("_n") - 1) * F.lit(float(p)) for p in wanted}
    found = ranked.groupBy(*groups, "_n").agg(
        *[at_rank(F.floor(position[p])).alias(f"_lo{i}") for i, p in enumerate(wanted)],
        *[at_rank(F.ceil(position[p])).alias(f"_hi{i}") for i, p in enumerate(wanted)],
    )

    def exact(name: str) -> Column:
        message = F.lit("quantile bracket missed its rank; raise the accuracy")
        return F.when(F.col(f"{name}._gap"), F.raise_error(message).cast("double")).otherwise(F.col(f"{name}._v"))

    out = []
    for name, p in probabilities.items():
        i = wanted.index(p)
        lo, hi = exact(f"_lo{i}"), exact(f"_hi{i}")
        out.append((lo + (hi - lo) * (position[p] - F.floor(position[p]))).alias(name))
    return found.select(*groups, *out)


def column_medians(df: DataFrame, keys: list[str], columns: dict[str, str]) -> DataFrame:
    """Exact medians of several columns per group in one pass: ``columns`` is output name -> input."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("_name"), F.col(source).cast("double").alias("_value"))
            for name, source in columns.items()
        ]
    )
    long = df.select(*keys, F.inline(pairs))
    medians = group_quantiles(long, [*keys, "_name"], "_value", {"_median": 0.5})
    # a group without any value has no median, but it is a group
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_median"))).alias(name) for name in columns]
    )


def counted_quantiles(
    counts: DataFrame,
    keys: list[str],
    value: str,
    times: str,
    probabilities: dict[str, float],
    *,
    direct_rows: int = DIRECT_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """Like ``group_quantiles`` for rows that stand for ``times`` equal values each, such as merged value counts.

    Groups of up to ``direct_rows`` distinct values are left to Spark's percentile with frequencies. In a larger one
    each wanted rank has a range of values, at first all. It is cut into cells of equal width, the
    cell with the rank becomes the range, and so on until it is one value. A step is one aggregation and a running
    sum over the cells, so no task sees a group.
    """
    data = counts.select(*keys, F.col(value).cast("double").alias("_v"), F.col(times).cast("long").alias("_c"))
    data = data.filter("_v is not null and _c > 0")
    sizes = data.groupBy(*keys).agg(
        F.sum("_c").alias("_n"), F.count(F.lit(1)).alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    large = settle(sizes.filter(F.col("_d") > direct_rows))
    some = large.limit(1).count() > 0
    rest = attach(data, large.select(*keys), keys, "left_anti", null_safe=True) if some else data
    small = rest.groupBy(*keys).agg(
        *[F.percentile("_v", F.lit(float(p)), F.col("_c")).alias(name) for name, p in probabilities.items()]
    )
    if not some:
        return small
    names = list(probabilities)
    ranks = [
        F.struct(F.lit(name).alias("_name"), F.lit(end).alias("_end"), rank(position).cast("long").alias("_rank"), (position - F.floor(position)).alias("_part"))
        for name in names
        for position in [(F.col("_n") - 1) * F.lit(float(probabilities[name]))]
        for end, rank in (("lo", F.floor), ("hi", F.ceil))
    ]
    target = [*keys, "_name", "_end", "_rank", "_part"]
    open_ = settle(large.select(*keys, "_lo", "_hi", F.lit(0).cast("long").alias("_before"), F.inline(F.array(*ranks))))
    found = []
    while open_.limit(1).count():
        found.append(open_.filter("_lo = _hi").select(*target, F.col("_lo").alias("_v")))
        met = attach(data, _grouped(open_.filter("_lo < _hi"), keys), keys, "inner", null_safe=True)
        met = met.select(*keys, "_v", "_c", F.inline("_targets")).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        width = F.col("_hi") / cells - F.col("_lo") / cells
        cell = F.least(F.floor((F.col("_v") / cells - F.col("_lo") / cells) / width * cells), F.lit(cells - 1))
        parts = met.withColumn("_cell", cell).groupBy(*target, "_before", "_cell").agg(
            F.sum("_c").alias("_in"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        upto = Window.partitionBy(*target).orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
        parts = parts.withColumn("_upto", F.col("_before") + F.sum("_in").over(upto))
        nearest = parts.filter(F.col("_upto") > F.col("_rank")).groupBy(*target).agg(
            F.min(F.struct("_cell", "_lo", "_hi", (F.col("_upto") - F.col("_in")).alias("_before"))).alias("_next")
        )
        open_ = settle(nearest.select(*target, "_next._lo", "_next._hi", "_next._before"))
    ends = reduce(DataFrame.unionByName, found).groupBy(*keys, "_name").agg(
        F.max(F.when(F.col("_end") == "lo", F.col("_v"))).alias("_a"),
        F.max(F.when(F.col("_end") == "hi", F.col("_v"))).alias("_b"),
        F.max("_part").alias("_part"),
    )
    exact = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")
    wide = ends.groupBy(*keys).agg(*[F.max(F.when(F.col("_name") == name, exact)).alias(name) for name in names])
    return small.unionByName(wide)


def _grouped(targets: DataFrame, keys: list[str]) -> DataFrame:
    """One row per group with its open ranks: two for each probability at most."""
    line = F.struct("_name", "_end", "_rank", "_part", "_lo", "_hi", "_before")
    return targets.groupBy(*keys).agg(F.collect_list(line).alias("_targets"))
