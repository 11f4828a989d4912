"""Agreement of two raters on the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_sheets(a: DataFrame, b: DataFrame, on: str, answer: str) -> DataFrame:
    """Answers of both sheets by id, with null where a sheet lacks the id. Ids are unique per sheet."""
    left = a.select(on, F.col(answer).alias("a"), F.lit(True).alias("_in_a"))
    right = b.select(on, F.col(answer).alias("b"), F.lit(True).alias("_in_b"))
    return left.join(right, on, "full_outer")


def kappa(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows, agreements, agreement share and Cohen's kappa of two answer columns, as one row.

    Rows without both answers are not paired; they are counted in ``unpaired``. Kappa is null
    where chance alone would agree every time.
    """
    table = pairs.groupBy(F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).agg(
        F.count(F.lit(1)).alias("n")
    )
    both = F.col("x").isNotNull() & F.col("y").isNotNull()
    cells = table.select(
        F.inline(
            F.when(
                both,
                F.array(
                    F.struct(F.col("x").alias("value"), F.col("n").alias("by_a"), F.lit(0).cast("long").alias("by_b"),
                             F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0).alias("agree"),
                             F.lit(0).cast("long").alias("unpaired")),
                    F.struct(F.col("y").alias("value"), F.lit(0).cast("long").alias("by_a"), F.col("n").alias("by_b"),
                             F.lit(0).cast("long").alias("agree"), F.lit(0).cast("long").alias("unpaired")),
                ),
            ).otherwise(
                F.array(
                    F.struct(F.lit(None).cast("string").alias("value"), F.lit(0).cast("long").alias("by_a"),
                             F.lit(0).cast("long").alias("by_b"), F.lit(0).cast("long").alias("agree"),
                             F.col("n").alias("unpaired"))
                )
            )
        )
    )
    margins = cells.groupBy("value").agg(*[F.sum(c).alias(c) for c in ("by_a", "by_b", "agree", "unpaired")])
    sums = margins.agg(
        F.coalesce(F.sum("by_a"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("agree"), F.lit(0)).alias("agreed"),
        F.coalesce(F.sum("unpaired"), F.lit(0)).alias("unpaired"),
        F.sum(F.col("by_a").cast("double") * F.col("by_b")).alias("_cross"),
    )
    observed = F.try_divide(F.col("agreed").cast("double"), F.col("rows"))
    chance = F.try_divide(F.col("_cross"), F.col("rows").cast("double") * F.col("rows"))
    return sums.select(
        "rows",
        "agreed",
        "unpaired",
        observed.alias("agreement"),
        F.try_divide(observed - chance, 1 - chance).alias("kappa"),
    )
