"""The feature table as mergeable state: what each lot of rows adds is kept, and lots are merged by key.

Counts and sums per entity and mode value give modes, means and row counts; counts per entity and value give exact
medians. Both only ever add up, so a table built from the state of two lots equals one built from all their rows,
and no row is read twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.functions.clean import utc
from punctual.operators.lookup import attach
from punctual.operators.quantiles import counted_quantiles


@dataclass(frozen=True)
class StoreSpec:
    """What a feature table is made of; see ``build_store``."""

    entity: str
    mode: str
    medians: dict[str, tuple[str, int | None]]
    means: dict[str, tuple[str, int | None]]
    unit: str = "km"


@dataclass(frozen=True)
class StoreState:
    """``counts`` (entity, mode, _n, a sum and a count per mean), ``values`` (entity, _name, _value, _n)."""

    counts: DataFrame
    values: DataFrame


def state_of(rows: DataFrame, spec: StoreSpec) -> StoreState:
    """What a lot of rows adds to the state."""
    counts = rows.groupBy(spec.entity, spec.mode).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col(c).cast("double")).alias(f"_sum_{name}") for name, (c, _) in spec.means.items()],
        *[F.count(c).alias(f"_cnt_{name}") for name, (c, _) in spec.means.items()],
    )
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("_name"), F.col(c).cast("double").alias("_value"))
            for name, (c, _) in spec.medians.items()
        ]
    )
    values = rows.select(spec.entity, F.inline(pairs)).filter("_value is not null")
    return StoreState(counts, values.groupBy(spec.entity, "_name", "_value").agg(F.count(F.lit(1)).alias("_n")))


def merged(state: StoreState, spec: StoreSpec) -> StoreState:
    """A state with one row per key again, from lots that were put one below the other."""
    sums = [c for c in state.counts.columns if c.startswith("_")]
    return StoreState(
        state.counts.groupBy(spec.entity, spec.mode).agg(*[F.sum(c).alias(c) for c in sums]),
        state.values.groupBy(spec.entity, "_name", "_value").agg(F.sum("_n").alias("_n")),
    )


def finished(state: StoreState, spec: StoreSpec, computed_at: Column | None = None) -> DataFrame:
    """The feature table of a merged state: commonest mode value (the smallest on a tie, null only if
    there is no other), exact medians, means, row count and stamps."""

    def rounded(column: Column, digits: int | None) -> Column:
        return column if digits is None else F.bround(column, digits)

    rank = F.struct(F.col(spec.mode).isNull(), -F.col("_n"), F.col(spec.mode))
    base = state.counts.groupBy(spec.entity).agg(
        F.min_by(spec.mode, rank).alias(spec.mode),
        *[
            rounded(F.try_divide(F.sum(f"_sum_{n}"), F.sum(f"_cnt_{n}")), digits).alias(n)
            for n, (_, digits) in spec.means.items()
        ],
        F.sum("_n").alias("orders_seen"),
    )
    middle = counted_quantiles(state.values, [spec.entity, "_name"], "_value", "_n", {"_median": 0.5})
    middle = middle.groupBy(spec.entity).agg(
        *[F.max(F.when(F.col("_name") == n, rounded(F.col("_median"), d))).alias(n) for n, (_, d) in spec.medians.items()]
    )
    stamp = utc(F.current_timestamp() if computed_at is None else computed_at.cast("timestamp"))
    return attach(base, middle, spec.entity, null_safe=True).withColumns(
        {"computed_at": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"), "distance_unit": F.lit(spec.unit)}
    )
