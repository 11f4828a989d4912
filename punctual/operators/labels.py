"""From raw orders to rows with a trustworthy duration."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctual.functions.calendar import calendar
from punctual.functions.clean import minutes_between, parse_ntz, shift_minutes
from punctual.operators.dedup import keep_first
from punctual.operators.lookup import attach
from punctual.operators.quantiles import counted_quantiles
from punctual.session import settle

# The columns of the order table, its known clock fault and the accepted range.
NATURAL_KEY = ("placed_at", "city", "restaurant_id", "courier_id", "distance_km", "subtotal_inr")


@dataclass(frozen=True)
class LabelRules:
    """Which columns mean what, and which rows can be labelled."""

    order_id: str = "order_id"
    placed: str = "placed_at"
    picked: str = "picked_up_at"
    delivered: str = "delivered_at"
    status: str = "status"
    done: str = "delivered"
    group: str = "city"
    skewed_group: str | None = "Pune"
    skew_minutes: int = 330
    max_minutes: float = 720
    late_minutes: float = 90
    natural_key: tuple[str, ...] = NATURAL_KEY

    def with_(self, **changes) -> LabelRules:
        return replace(self, **changes)


def with_times(df: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """Add ``placed_utc`` and ``actual_minutes``, plus the parsed pick-up and delivery times."""
    placed = parse_ntz(rules.placed)
    if rules.skewed_group is not None:
        ahead = F.col(rules.group) == rules.skewed_group
        placed = F.when(ahead, shift_minutes(placed, -rules.skew_minutes)).otherwise(placed)
    parsed = F.struct(
        placed.alias("placed_utc"),
        parse_ntz(rules.picked).alias("_picked"),
        parse_ntz(rules.delivered).alias("_delivered"),
    )
    # As a generated row the parsed times are computed once; as plain columns every later rule
    # that names one of them would parse the text again.
    times = df.select("*", F.inline(F.array(parsed)))
    return times.withColumn("actual_minutes", minutes_between(F.col("_delivered"), F.col("placed_utc")))


def drop_reason(rules: LabelRules = LabelRules()) -> Column:
    """The first rule a row of ``with_times`` fails, or null if it can be labelled."""
    def fails(check: Column) -> Column:
        return ~F.coalesce(check, F.lit(False))

    return (
        F.when(fails(F.col(rules.status) == rules.done), "not_delivered")
        .when(F.col("_delivered").isNull(), "no_delivery_time")
        .when(fails(F.col("_delivered") > F.col("_picked")), "delivered_before_pickup")
        .when(fails(F.col("actual_minutes") > 0), "not_positive")
        .when(fails(F.col("actual_minutes") < rules.max_minutes), "too_long")
    )


def label(df: DataFrame, rules: LabelRules = LabelRules(), *, drop_duplicates: bool = True) -> DataFrame:
    """Labelled rows: durations in range, one row per natural key, calendar columns, late flag.

    The status and the presence of a delivery are filtered first, where the scan can do it.
    """
    done = df.filter((F.col(rules.status) == rules.done) & F.col(rules.delivered).isNotNull())
    kept = with_times(done, rules).filter(drop_reason(rules).isNull()).drop("_picked", "_delivered")
    if drop_duplicates:
        kept = keep_first(kept, list(rules.natural_key), [rules.order_id])
    return kept.withColumns(
        {**calendar("placed_utc"), "severely_late": F.col("actual_minutes") > rules.late_minutes}
    )


def drop_ledger(df: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """Rows kept, and rows lost to each rule and to deduplication, with their share of the input.

    Rows that fail a rule collapse to one group per reason before the shuffle; the others are
    counted per natural key, so the surplus over one is what deduplication removes.
    """
    reasoned = with_times(df, rules).withColumn("reason", drop_reason(rules))
    keys = {
        f"_k{i}": F.when(F.col("reason").isNull(), F.col(c)) for i, c in enumerate(rules.natural_key)
    }
    groups = reasoned.select("reason", *[c.alias(n) for n, c in keys.items()]).groupBy("reason", *keys)
    counted = groups.agg(F.count(F.lit(1)).alias("n"))
    lines = counted.select(
        F.inline(
            F.when(
                F.col("reason").isNull(),
                F.array(
                    F.struct(F.lit("kept").alias("outcome"), F.lit(1).cast("long").alias("rows")),
                    F.struct(F.lit("duplicate").alias("outcome"), (F.col("n") - 1).alias("rows")),
                ),
            ).otherwise(F.array(F.struct(F.col("reason").alias("outcome"), F.col("n").alias("rows"))))
        )
    )
    ledger = lines.groupBy("outcome").agg(F.sum("rows").alias("rows")).filter(F.col("rows") > 0)
    # at most one line per outcome is left here
    return ledger.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def naive_minutes_by_group(df: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """The uncleaned duration per group: median and share below zero. A clock fault stands out."""
    naive = df.select(
        F.col(rules.group),
        minutes_between(parse_ntz(rules.delivered), parse_ntz(rules.placed)).alias("naive_minutes"),
    )
    # each row is parsed once; shares and medians come from counts per value
    counts = settle(naive.groupBy(rules.group, "naive_minutes").agg(F.count(F.lit(1)).alias("n")))
    known = F.sum(F.when(F.col("naive_minutes").isNotNull(), F.col("n")))
    below = F.sum(F.when(F.col("naive_minutes") < 0, F.col("n")).otherwise(0))
    shares = counts.groupBy(rules.group).agg(F.try_divide(below, known).alias("share_negative"))
    medians = counted_quantiles(counts, [rules.group], "naive_minutes", "n", {"median_minutes": 0.5})
    return attach(shares, medians, rules.group, null_safe=True).orderBy("median_minutes", rules.group)


def label_checks(labelled: DataFrame, raw: DataFrame, rules: LabelRules = LabelRules()) -> DataFrame:
    """What a labelled table must satisfy, as one row of measures."""
    in_skewed = (F.col(rules.group) == rules.skewed_group) if rules.skewed_group else F.lit(False)
    raw_rows = raw.agg(F.count(F.lit(1)).alias("n")).scalar()
    return labelled.agg(
        F.count_if(F.col("actual_minutes").isNull()).alias("null_labels"),
        F.min("actual_minutes").alias("min_minutes"),
        F.max("actual_minutes").alias("max_minutes"),
        F.count(F.lit(1)).alias("rows"),
        F.avg(in_skewed.cast("double")).alias("skewed_group_share"),
    ).withColumn("kept_share", F.try_divide(F.col("rows"), raw_rows))


def assert_labels(checks: DataFrame, rules: LabelRules = LabelRules(), *, kept=(0.80, 0.95), skewed=0.10) -> None:
    """Raise if the measures of ``label_checks`` are out of bounds."""
    row = checks.first()
    assert row["null_labels"] == 0, f"{row['null_labels']} labels are null"
    assert row["min_minutes"] > 0, f"shortest label is {row['min_minutes']}"
    assert row["max_minutes"] < rules.max_minutes, f"longest label is {row['max_minutes']}"
    assert kept[0] < row["kept_share"] < kept[1], f"kept {row['kept_share']:.1%}"
    if rules.skewed_group:
        assert row["skewed_group_share"] > skewed, f"{rules.skewed_group}: {row['skewed_group_share']:.1%}"


def labelling_diff(a: DataFrame, b: DataFrame, on: str, label_column: str = "actual_minutes") -> DataFrame:
    """Two labellings of the same raw table: rows only A kept, only B kept, both, and both but different.

    Both sides are stacked and grouped by id, which combines before the shuffle and needs no join.
    """
    sides = [
        df.select(
            on,
            F.lit(side).alias("side"),
            F.col(label_column).cast("double").alias("minutes"),
        )
        for side, df in (("a", a), ("b", b))
    ]
    in_a, in_b = F.col("side") == "a", F.col("side") == "b"
    merged = (
        sides[0]
        .unionByName(sides[1])
        .groupBy(on)
        .agg(
            F.bool_or(in_a).alias("in_a"),
            F.bool_or(in_b).alias("in_b"),
            F.max(F.when(in_a, F.col("minutes"))).alias("a_minutes"),
            F.max(F.when(in_b, F.col("minutes"))).alias("b_minutes"),
        )
    )
    outcome = (
        F.when(~F.col("in_b"), "only_a")
        .when(~F.col("in_a"), "only_b")
        .when(F.col("a_minutes").eqNullSafe(F.col("b_minutes")), "same")
        .otherwise("different_label")
    )
    return merged.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("orders"))
