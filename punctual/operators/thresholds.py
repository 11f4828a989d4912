"""Threshold sweeps over a score: average precision and the best recall at a precision.

Rows are first reduced to one line per distinct score. Running totals over those lines are
built in steps, totals per score range and then within each range, so that no single
task has to see all distinct scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.operators.lookup import attach
from punctual.session import settle

LINES_PER_RANGE = 500_000
MOST_RANGES, RANGES_PER_BLOCK = 1_000_000, 1_000


def sweep(df: DataFrame, score: str, positive: Column, *, lines_per_range: int = LINES_PER_RANGE) -> DataFrame:
    """One row per distinct score, seen as a threshold ``score >= threshold``.

    Columns: threshold, hits (positives at exactly this score), caught and flagged (positives
    and rows at or above it), positives (all of them). Rows without a score are left out.
    """
    lines = settle(
        df.filter(F.col(score).isNotNull() & positive.isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(F.count_if(positive).alias("hits"), F.count(F.lit(1)).alias("rows"))
    )
    # distinct scores dealt to ranges by sampled splitters; a range is a partition, written with its number
    ranges = min(max(1, -(-lines.count() // lines_per_range)), MOST_RANGES)
    dealt = lines.repartitionByRange(ranges, F.desc("threshold")) if ranges > 1 else lines.coalesce(1)
    placed = settle(dealt.withColumn("_range", F.spark_partition_id()))
    totals = placed.groupBy("_range").agg(F.sum("hits").alias("_h"), F.sum("rows").alias("_r"))
    totals = settle(totals.withColumn("_block", F.floor(F.col("_range") / RANGES_PER_BLOCK)))
    # at most MOST_RANGES / RANGES_PER_BLOCK blocks: the only window without a key
    blocks = totals.groupBy("_block").agg(F.sum("_h").alias("_h"), F.sum("_r").alias("_r"))
    blocks = _above(blocks, [], "_block").select("_block", F.col("_ha").alias("_hb"), F.col("_ra").alias("_rb"))
    offsets = attach(_above(totals, ["_block"], "_range"), blocks, "_block").select(
        "_range", (F.col("_ha") + F.col("_hb")).alias("_hits_above"), (F.col("_ra") + F.col("_rb")).alias("_rows_above")
    )
    running = Window.partitionBy("_range").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    positives = placed.agg(F.sum("hits").alias("n")).scalar()
    return attach(placed, offsets, "_range").select(
        "threshold",
        "hits",
        (F.col("_hits_above") + F.sum("hits").over(running)).alias("caught"),
        (F.col("_rows_above") + F.sum("rows").over(running)).alias("flagged"),
        positives.alias("positives"),
    )


def _above(totals: DataFrame, within: list[str], order: str) -> DataFrame:
    """``totals`` with the sums of _h and _r of the rows before, as _ha and _ra."""
    before = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumns({f"{c}a": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("_h", "_r")})


def average_precision(swept: DataFrame) -> DataFrame:
    """Step-wise area under the precision-recall curve, as one row."""
    step = F.try_divide(F.col("hits"), F.col("positives")) * F.col("caught") / F.col("flagged")
    return swept.agg(F.sum(step).alias("avg_precision"))


def recall_at_precision(swept: DataFrame, min_precision: float = 0.10) -> DataFrame:
    """Best recall with precision >= ``min_precision`` and the highest threshold that gives it.

    Recall is 0 and the threshold null if no threshold is precise enough.
    """
    recall = F.coalesce(F.try_divide(F.col("caught"), F.col("positives")), F.lit(0.0))
    fine = swept.filter(F.col("caught") / F.col("flagged") >= min_precision).withColumn("_recall", recall)
    best = fine.agg(F.max(F.struct(F.col("_recall").alias("recall"), "threshold")).alias("best"))
    return best.select(
        F.coalesce(F.col("best.recall"), F.lit(0.0)).alias("recall"), F.col("best.threshold").alias("threshold")
    )


# Cells that a score between 0 and 1 is dealt to: its leading bits.
CELL_BITS = 12


def score_cells(df: DataFrame, score: str, positive: Column, *, bits: int = CELL_BITS) -> DataFrame:
    """Counts per cell of the score: cell, low (its smallest score), hits, rows.

    At most ``2 ** bits`` rows, whatever the number of scores, and mergeable: see ``merged_cells``. Scores lie between
    0 and 1. Rows without a score or a label are left out.
    """
    cell = F.least(F.floor(F.col(score).cast("double") * (1 << bits)), F.lit((1 << bits) - 1)).cast("int")
    known = df.filter(F.col(score).isNotNull() & positive.isNotNull())
    return known.groupBy(cell.alias("cell")).agg(
        F.min(F.col(score).cast("double")).alias("low"), F.count_if(positive).alias("hits"), F.count(F.lit(1)).alias("rows")
    )


def merged_cells(cells: DataFrame) -> DataFrame:
    """The cells of all rows from those of parts of them, such as days or micro-batches, put one below the other."""
    return cells.groupBy("cell").agg(F.min("low").alias("low"), F.sum("hits").alias("hits"), F.sum("rows").alias("rows"))


def bounded_sweep(cells: DataFrame, min_precision: float = 0.10) -> DataFrame:
    """One row: bounds of the average precision and of the best recall at a precision, from merged cells.

    Columns: ap_low, ap_high, recall_low, recall_high, threshold. The exact values lie within the bounds whatever
    the order of the scores within a cell. Every cell's smallest score is a threshold whose counts are
    exact: ``threshold`` is the one that reaches ``recall_low``. With T positives and F others above a cell of p and n,
    its positives add at most p * (T + p) / (T + F + p) and at least p - (F + n) * ln((T + F + n + p) / (T + F + n))
    to the sum of precisions.
    """
    running = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    # at most 2 ** bits rows: the only window without a key
    upto = cells.withColumns({"_t": F.sum("hits").over(running), "_r": F.sum("rows").over(running)})
    p, t, r = (F.col(c).cast("double") for c in ("hits", "_t", "_r"))
    before = r - p
    others = r - t
    high = p * F.try_divide(t, r - (F.col("rows") - F.col("hits")))
    low = F.when(before > 0, F.greatest(p - others * F.log(r / before), F.lit(0.0))).otherwise(p)
    best = F.max(F.when(t / r >= min_precision, F.struct(t.alias("t"), F.col("low").alias("threshold"))))
    most = F.max(F.when(F.try_divide(t, r - (F.col("rows") - F.col("hits"))) >= min_precision, t))
    found = upto.agg(
        F.sum(F.when(p > 0, low)).alias("_low"), F.sum(F.when(p > 0, high)).alias("_high"), best.alias("_best"),
        most.alias("_most"), F.sum("hits").alias("_p"),
    )

    def share(column: Column) -> Column:
        return F.coalesce(F.try_divide(column, F.col("_p")), F.lit(0.0))

    return found.select(
        share(F.col("_low")).alias("ap_low"), share(F.col("_high")).alias("ap_high"), share(F.col("_best.t")).alias("recall_low"),
        share(F.col("_most")).alias("recall_high"), F.col("_best.threshold").alias("threshold"),
    )
