"""Measures of scored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.calendar import is_night, is_peak, is_weekend
from punctual.operators.agreement import kappa, pair_sheets
from punctual.operators.behaviour import implausible, never_lower, score_twice, shift_report, unchanged
from punctual.operators.evaluation import (
    alpha_report,
    baseline_table,
    confusion_report,
    promise_counters,
    quantile_promises,
    regression_report,
)
from punctual.operators.profile import positive_rate
from punctual.operators.slices import group_errors, over_budget, period_report, slice_report, worst_slice
from punctual.operators.split import cut_time, time_split, with_side
from punctual.operators.thresholds import average_precision, recall_at_precision, sweep
from punctual.plans.catalogue.adapters import EVENTS, HOLDOUT_DAYS, events, rules_minutes, sides, table
from punctual.plans.catalogue.registry import query, rounded


@query(f"with {EVENTS} select event_id, pred from ev")
def rules_baseline(spark: SparkSession, sf: str) -> DataFrame:
    """Hand-written rules as a column expression."""
    return events(spark, sf).select("event_id", "pred")


R2 = "1 - avg((pred - value) * (pred - value)) / var_pop(value)"


@query(
    f"""
    with {EVENTS}
    select event_type, count(*) as n, avg(abs(pred - value)) as mae, avg(pred - value) as bias,
           round({R2}, 6) as r2
    from ev group by event_type
    """
)
def regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """MAE, bias and R2 per group."""
    return rounded(regression_report(events(spark, sf), "pred", "value", ["event_type"]), ["r2"])


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}, m as (select avg(value) as v from tr),
    p as (
      select 'predict the mean' as baseline, (select v from m) as pred, value from te
      union all select 'promise', 2000.0 + k * 50.0, value from te
      union all select 'rules', pred, value from te)
    select baseline, avg(abs(pred - value)) as mae, avg(pred - value) as bias,
           round({R2}, 6) as r2 from p group by baseline
    """
)
def baseline_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """M3 M2: several predictions of the same held-out rows."""
    train, test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)
    mean = train.agg(F.avg("value").alias("m")).scalar()
    table_ = baseline_table(
        test, "value", {"predict the mean": mean, "promise": F.lit(2000.0) + F.col("k") * 50, "rules": F.col("pred")}
    )
    return rounded(table_, ["r2"])


CONFUSION = """
count(case when hit and pos then 1 end) as caught, count(case when not hit and pos then 1 end) as missed,
count(case when hit and not pos then 1 end) as false_alarms, count(case when not hit and not pos then 1 end) as rejected,
count(case when hit = pos then 1 end)::double / greatest(count(*), 1) as accuracy,
count(case when hit and pos then 1 end)::double / greatest(count(case when hit then 1 end), 1) as precision,
count(case when hit and pos then 1 end)::double / greatest(count(case when pos then 1 end), 1) as recall
"""


@query(
    f"""
    with {EVENTS},
    d as (select 'never' as model, false as hit, value > 9000 as pos from ev
          union all select 'long promise', pred >= 6500, value > 9000 from ev
          union all select 'busy hours', hour in (12, 13, 19, 20), value > 9000 from ev)
    select model, {CONFUSION} from d group by model
    """
)
def confusion_table(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, accuracy, precision and recall of several decisions."""
    decisions = {"never": F.lit(False), "long promise": F.col("pred") >= 6500, "busy hours": is_peak()}
    return confusion_report(events(spark, sf), decisions, F.col("value") > 9000)


SWEEP = """
s as (select value as threshold, count(case when event_type = 'purchase' then 1 end) as hits, count(*) as rows
      from events group by value),
w as (select threshold, hits, cast(sum(hits) over (order by threshold desc) as bigint) as caught,
             cast(sum(rows) over (order by threshold desc) as bigint) as flagged,
             cast(sum(hits) over () as bigint) as positives from s)
"""


def _swept(spark: SparkSession, sf: str) -> DataFrame:
    return sweep(table(spark, sf, "events"), "value", F.col("event_type") == "purchase")


@query(f"with {SWEEP} select threshold, hits, caught, flagged, positives from w")
def threshold_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """Running counts over all distinct scores."""
    return _swept(spark, sf)


@query(f"with {SWEEP} select round(sum(hits::double / positives * caught / flagged), 6) as avg_precision from w")
def average_precision_score(spark: SparkSession, sf: str) -> DataFrame:
    """Step-wise area under the precision-recall curve."""
    return rounded(average_precision(_swept(spark, sf)), ["avg_precision"])


@query(
    f"""
    with {SWEEP},
    fine as (select caught::double / positives as recall, threshold from w where caught::double / flagged >= 0.21),
    best as (select * from fine order by recall desc, threshold desc limit 1)
    select coalesce((select recall from best), 0.0::double) as recall, (select threshold from best) as threshold
    """
)
def recall_at_min_precision(spark: SparkSession, sf: str) -> DataFrame:
    """Best recall at a precision, and its threshold."""
    return recall_at_precision(_swept(spark, sf), 0.21)


@query(
    f"""
    with {EVENTS}, x as (select avg(case when value > 9000 then 1.0 else 0.0 end) as positive_rate from ev)
    select positive_rate, cast(floor(1 / positive_rate) as bigint) as one_in from x
    """
)
def positive_share(spark: SparkSession, sf: str) -> DataFrame:
    """Share of the rare class."""
    return positive_rate(events(spark, sf), F.col("value") > 9000)


@query(
    """
    with x as (select quality as a, toxic as b from labels),
    n as (select count(*)::double as n from x),
    o as (select count(*) as agreed from x where a = b),
    e as (select sum(pa * pb) as pe from (
            select v, (select count(*) from x where a = v) / (select n from n) as pa,
                      (select count(*) from x where b = v) / (select n from n) as pb
            from (select distinct a as v from x union select distinct b from x)))
    select cast((select n from n) as bigint) as rows, agreed, cast(0 as bigint) as unpaired, agreed / (select n from n) as agreement,
           round((agreed / (select n from n) - (select pe from e)) / (1 - (select pe from e)), 9) as kappa
    from o
    """
)
def rater_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """Two answer sheets paired by id."""
    rows = table(spark, sf, "labels")
    pairs = pair_sheets(rows.select("doc_id", "quality").withColumnRenamed("quality", "answer"),
                        rows.select("doc_id", "toxic").withColumnRenamed("toxic", "answer"), "doc_id", "answer")
    return rounded(kappa(pairs), ["kappa"], 9)


COUNTERS = """
avg(case when pred < value then 1.0 else 0.0 end) as promises_broken,
sum(greatest(pred - value, 0)) as idle_minutes, sum(greatest(pred - value, 0)) * 1000 / count(*) as idle_per_1k, avg(abs(pred - value)) as mae
"""


@query(f"with {EVENTS} select event_type, {COUNTERS} from ev group by event_type")
def promise_report(spark: SparkSession, sf: str) -> DataFrame:
    """Promises broken and idle minutes."""
    return promise_counters(events(spark, sf), "pred", "value", ["event_type"])


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    a as (select unnest([0.5, 0.6, 0.7, 0.8, 0.9])::double as alpha),
    q as (
      select event_type, 0.5::double as alpha, quantile_cont(value - pred, 0.5) as q from tr group by 1
      union all select event_type, 0.6, quantile_cont(value - pred, 0.6) from tr group by 1
      union all select event_type, 0.7, quantile_cont(value - pred, 0.7) from tr group by 1
      union all select event_type, 0.8, quantile_cont(value - pred, 0.8) from tr group by 1
      union all select event_type, 0.9, quantile_cont(value - pred, 0.9) from tr group by 1),
    p as (select q.alpha, te.pred + q.q as pred, value from te join q on te.event_type = q.event_type)
    select alpha, avg(case when pred < value then 1.0 else 0.0 end) as promises_broken,
           round(sum(greatest(pred - value, 0)) * 1000 / count(*), 2) as idle_per_1k,
           round(avg(abs(pred - value)), 4) as mae, round(quantile_cont(pred, 0.5), 4) as median_promise from p group by alpha
    """
)
def quantile_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """A promise per alpha from train residual quantiles, with both counters."""
    train, test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)
    report = alpha_report(quantile_promises(train, test, "pred", "value", "event_type"), "value")
    return rounded(rounded(report, ["mae", "median_promise"], 4), ["idle_per_1k"], 2)


def slices() -> dict[str, Column]:
    return {
        "night": is_night(),
        "peak": is_peak(),
        "weekend": is_weekend(),
        "short": F.col("k") < 2,
        "long": F.col("k") > 80,
        "purchase": F.col("event_type") == "purchase",
        "severely late": F.col("value") > 9000,
        "never": F.col("k") < 0,
    }


SLICE_SQL = f"""
{sides(HOLDOUT_DAYS)},
sl as (
  select unnest(list_filter([
    case when hour >= 21 or hour < 9 then 'night' end, case when hour in (12, 13, 19, 20) then 'peak' end,
    case when dow >= 6 then 'weekend' end, case when k < 2 then 'short' end, case when k > 80 then 'long' end,
    case when event_type = 'purchase' then 'purchase' end, case when value > 9000 then 'severely late' end],
    lambda x: x is not null)) as slice, pred, value from te),
ov as (select avg(abs(pred - value)) as m from te),
report as (
  select slice, count(*) as rows, avg(abs(pred - value)) as mae,
         avg(abs(pred - value)) / (select m from ov) as vs_overall, avg(pred - value) as bias
  from sl group by slice having count(*) >= 20)
"""


def _slices(spark: SparkSession, sf: str) -> DataFrame:
    test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)[1]
    return slice_report(test, slices(), "pred", "value", min_rows=20)


@query(f"with {EVENTS}, {SLICE_SQL} select * from report")
def slice_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors of overlapping slices in one pass."""
    return _slices(spark, sf)


@query(f"with {EVENTS}, {SLICE_SQL} select * from report where vs_overall > 1.25")
def slice_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Slices much worse than the overall error."""
    return over_budget(_slices(spark, sf))


@query(f"with {EVENTS}, {SLICE_SQL} select * from report order by vs_overall desc, slice limit 1")
def worst_slice_line(spark: SparkSession, sf: str) -> DataFrame:
    """O2: the worst slice."""
    return worst_slice(_slices(spark, sf))


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}
    select case when ts >= (select cut_at from cut) then 'held_out' when dayofyear(ts) < 12 then 'before' else 'after' end
             as period, count(*) as rows, avg(value) as mean_actual, avg(pred) as mean_predicted,
           avg(pred - value) as bias
    from ev group by 1
    """
)
def regime_report(spark: SparkSession, sf: str) -> DataFrame:
    """Truth, prediction and bias before and after a shift and on the held-out rows."""
    rows = events(spark, sf)
    period = (
        F.when(F.col("ts") >= cut_time(rows, "ts", HOLDOUT_DAYS), "held_out")
        .when(F.dayofyear("ts") < 12, "before")
        .otherwise("after")
    )
    return period_report(rows, period, "pred", "value")


@query(
    f"""
    with {EVENTS}
    select strftime(ts, '%Y-%m-%d') as day, count(*) as rows, avg(abs(pred - value)) as mae,
           avg(pred - value) as bias from ev group by 1
    """
)
def daily_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Errors per day, the batch form of the streaming monitor."""
    rows = events(spark, sf).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    return group_errors(rows, ["day"], "pred", "value")


def falling_rules(rows: DataFrame) -> DataFrame:
    """Rules with a fault: far away trips are promised a shorter time."""
    return rows.withColumn("pred", rules_minutes() - F.when(F.col("k") > 120, 4000.0).otherwise(0.0))


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    x as (select pred - case when k > 120 then 4000.0 else 0.0 end as a,
                 pred + k * 50.0 - case when k * 2 > 120 then 4000.0 else 0.0 end as b from te)
    select count(*) as rows, count(case when b < a - 0.01 then 1 end) as violations from x
    """
)
def directional_violations(spark: SparkSession, sf: str) -> DataFrame:
    """Doubling the distance must not lower the estimate."""
    test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)[1].drop("pred")
    return never_lower(score_twice(test, falling_rules, {"k": F.col("k") * 2}))


@query(f"with {EVENTS}, {sides(HOLDOUT_DAYS)} select count(*) as rows, cast(0 as bigint) as violations from te")
def invariance_violations(spark: SparkSession, sf: str) -> DataFrame:
    """A different id must not change the estimate."""
    test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)[1].drop("pred")
    return unchanged(score_twice(test, falling_rules, {"event_id": F.lit(-1).cast("long")}))


@query(
    f"""
    with {EVENTS} select count(*) as rows, count(case when not (pred between 2500 and 7000) then 1 end) as violations from ev
    """
)
def implausible_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Estimates outside a plausible band."""
    return implausible(events(spark, sf), "pred", (2500.0, 7000.0))


@query(
    f"""
    with {EVENTS},
    g as (select user_id, avg(pred) as a, avg(pred + k * 49950.0) as b from ev group by user_id)
    select count(*) as groups, count(case when greatest(a, b) / least(a, b) > 1.5 then 1 end) as moved_groups,
           max(greatest(a, b) / least(a, b)) as max_ratio, round(stddev_pop(a), 6) as spread_before,
           round(stddev_pop(b), 6) as spread_after from g
    """
)
def prediction_shift(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows scored before and after a unit change."""
    rows = events(spark, sf).drop("pred")
    scored = score_twice(rows, lambda df: df.withColumn("pred", rules_minutes()), {"k": F.col("k") * 1000})
    return rounded(shift_report(scored, "user_id"), ["spread_before", "spread_after"])


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    s as (select *, 'train' as side from tr union all select *, 'test' from te)
    select side, {COUNTERS} from s group by side
    """
)
def promise_by_side(spark: SparkSession, sf: str) -> DataFrame:
    """The counters on both sides of the split."""
    sided = with_side(events(spark, sf), "ts", HOLDOUT_DAYS)
    return promise_counters(sided, "pred", "value", ["side"])
