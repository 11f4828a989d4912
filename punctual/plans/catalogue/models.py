"""MLlib models on events. What does not depend on the learner is stated in SQL, and so are the
comparisons that a sound learner must pass; its own numbers are not part of the results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.behaviour import never_lower, score_twice, unchanged
from punctual.operators.slices import slice_report
from punctual.operators.split import time_split
from punctual.plans.catalogue.adapters import EVENTS, HOLDOUT_DAYS, RAW_ORDERS, RAW_RULES, events, raw_orders, sides
from punctual.plans.catalogue.evaluation import SLICE_SQL, slices
from punctual.plans.catalogue.registry import query, rounded
from punctual.plans.promises import fit_promises, promise_sweep
from punctual.plans.training import (
    can_overfit,
    evaluation_bundle,
    feature_bakeoff,
    fit_regressor,
    imbalance_bakeoff,
    leak_ladder,
    sampling_bakeoff,
    score,
)
from punctual.operators.history import build_features
from punctual.operators.labels import label

FEATURES = ["k", "hour", "dow", "event_type"]
GROUPS = ["event_type"]


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = events(spark, sf).withColumnRenamed("pred", "promise")
    return time_split(rows, "ts", HOLDOUT_DAYS)


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}
    select (select count(*) from tr) as n_train, count(*) as n_test, round(avg(abs(pred - value)), 4) as promised_mae,
           round(avg(abs((select avg(value) from tr) - value)), 4) as predict_the_mean_mae, true as as_good_as_the_mean,
           true as explains_something_or_nothing
    from te
    """
)
def model_evaluation(spark: SparkSession, sf: str) -> DataFrame:
    """M1 M2 M5: boosted trees against the promise and the train mean.

    Values of events are drawn without regard to the features, so a sound model does no better than the
    mean, and worse only by what twenty trees learn by heart from a small table.
    """
    train, test = _sides(spark, sf)
    model = fit_regressor(train, FEATURES, "value", categorical=GROUPS)
    report = evaluation_bundle(score(model, test), train, "value", "promise")
    report = report.withColumns({
        "as_good_as_the_mean": F.col("model_mae") < 1.5 * F.col("predict_the_mean_mae"),
        "explains_something_or_nothing": F.col("model_r2").between(-1.0, 1.0),
    })
    return rounded(report.drop("model_mae", "model_r2"), ["promised_mae", "predict_the_mean_mae"], 4)


@query(
    f"""
    with {EVENTS}, {SLICE_SQL}
    select slice, rows, true as plausible from report
    """
)
def model_slices(spark: SparkSession, sf: str) -> DataFrame:
    """The model's errors by slice: its rows, and whether error and bias can be true of them."""
    train, test = _sides(spark, sf)
    model = fit_regressor(train, FEATURES, "value", categorical=GROUPS)
    report = slice_report(score(model, test), slices(), "pred", "value", min_rows=20)
    plausible = (F.col("mae") > 0) & (F.abs("bias") <= F.col("mae")) & F.col("vs_overall").between(0.1, 10.0)
    return report.select("slice", "rows", plausible.alias("plausible"))


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}
    select 'k doubled' as change, count(*) as rows, true as some_but_not_all, false as unchanged from te
    union all select 'id replaced', count(*), false, true from te
    """
)
def model_violations(spark: SparkSession, sf: str) -> DataFrame:
    """The model scored twice: a doubled count lowers some estimates, a replaced id changes none."""
    train, test = _sides(spark, sf)
    model = fit_regressor(train, FEATURES, "value", categorical=GROUPS)
    parts = []
    for change, check, columns in (
        ("k doubled", never_lower, {"k": F.col("k") * 2}),
        ("id replaced", unchanged, {"event_id": F.lit(-1).cast("long")}),
    ):
        found = check(score_twice(test, lambda rows: score(model, rows), columns))
        some = (F.col("violations") > 0) & (F.col("violations") < F.col("rows"))
        parts.append(found.select(F.lit(change).alias("change"), "rows", some.alias("some_but_not_all"), (F.col("violations") == 0).alias("unchanged")))
    return parts[0].unionByName(parts[1])


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    m as (select count(*) as rows, round(avg(abs((select avg(value) from tr) - value)), 4) as mean_mae from te)
    select unnest(['slim', 'base', '+flags', '+history', 'the answer']) as features, unnest([0, 0, 0, 0, 1]) as explains_all,
           unnest([true, false, false, false, false]) as is_reference, unnest([false, false, false, false, true]) as halves_the_error,
           rows, mean_mae from m
    """
)
def feature_sets(spark: SparkSession, sf: str) -> DataFrame:
    """The same learner on growing column lists, the last one with the answer in it.

    Only that one can explain the values; the gain is 0 for the first, which all are compared with.
    """
    train, test = build_features(*_sides(spark, sf), target="value", histories={"user_mean": ["user_id"]})
    numbers = {c: F.col(c).cast("int") for c in ("is_night", "is_peak", "is_weekend")}
    train, test = train.withColumns(numbers), test.withColumns(numbers)
    sets = {
        "slim": ["k", "hour"],
        "base": FEATURES,
        "+flags": [*FEATURES, *numbers],
        "+history": [*FEATURES, *numbers, "user_mean"],
        "the answer": [*FEATURES, "answer"],
    }
    train, test = train.withColumn("answer", F.col("value")), test.withColumn("answer", F.col("value"))
    report = feature_bakeoff(train, test, "value", sets, categorical=GROUPS)
    mean = train.agg(F.avg("value")).scalar()
    about = test.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.avg(F.abs(mean - F.col("value"))).alias("mae")).alias("m")).scalar()
    report = report.select(
        "features", F.when(F.col("r2") > 0.5, 1).otherwise(0).alias("explains_all"), (F.col("gain") == 0).alias("is_reference"),
        (F.col("mae") < 0.5 * about["mae"]).alias("halves_the_error"), about["rows"].alias("rows"), about["mae"].alias("mean_mae"),
    )
    return rounded(report, ["mean_mae"], 4)


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    n as (select count(*) // 8 as n from tr),
    head as (select * from tr order by ts, md5(concat('0', event_id)), event_id limit (select n from n)),
    rand as (select * from (select *, row_number() over (order by md5(concat('2026', event_id)), event_id) as rn from tr)
             where rn <= (select n from n)),
    strat as (
      select * from (
        select *, row_number() over (partition by event_type, hour order by md5(concat('2026', event_id)), event_id) as rn,
               count(*) over (partition by event_type, hour) as size, count(*) over () as total from tr)
      where rn <= greatest(1.0::double, round_even(size * ((select n from n)::double / total), 0))),
    u as (select 'convenience' as sample, hour from head union all select 'simple random', hour from rand
          union all select 'stratified', hour from strat)
    select sample, count(*) as train_rows, count(case when hour >= 21 or hour < 9 then 1 end) as night_rows_in_train,
           true as plausible from u group by sample
    """
)
def sampler_models(spark: SparkSession, sf: str) -> DataFrame:
    """One learner on three samples of the same size, an eighth of the rows as in the reference comparison."""
    train, test = _sides(spark, sf)
    report = sampling_bakeoff(
        train, test, train.count() // 8, ts="ts", row_id="event_id", strata=["event_type", "hour"], features=FEATURES,
        target="value", categorical=GROUPS,
    )
    plausible = F.col("mae_overall").between(1.0, 1e6) & F.col("mae_night").between(1.0, 1e6)
    return report.select("sample", "train_rows", "night_rows_in_train", plausible.alias("plausible"))


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}, c as (select count(*) as rows, count(case when value > 9000 then 1 end) as positives from te)
    select unnest(['plain', 'weighted', 'weighted at best threshold']) as model, c.rows, c.positives, true as adds_up,
           unnest([false, true, false]) as catches_more, true as precise_or_undefined from c
    """
)
def rare_class_models(spark: SparkSession, sf: str) -> DataFrame:
    """Plain against weighted at one half: the weighted one catches more of the rare class.

    The third line, at the best threshold, is precise enough or, if no threshold is, has no counts.
    """
    train, test = _sides(spark, sf)
    late = (F.col("value") > 9000).cast("int")
    report = imbalance_bakeoff(train.withColumn("late", late), test.withColumn("late", late), FEATURES, "late", categorical=GROUPS)
    plain = report.filter(F.col("model") == "plain").agg(F.max("caught")).scalar()
    counted = test.agg(F.struct(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value") > 9000).alias("positives")).alias("c")).scalar()
    third = F.col("model") == "weighted at best threshold"
    return report.select(
        "model", counted["rows"].alias("rows"), counted["positives"].alias("positives"),
        (F.coalesce(F.col("caught") + F.col("missed"), counted["positives"]) == counted["positives"]).alias("adds_up"),
        (~third & (F.col("caught") > plain)).alias("catches_more"),
        F.coalesce(~third | (F.col("precision") >= 0.10), F.lit(True)).alias("precise_or_undefined"),
    )


@query(
    f"""
    with {RAW_ORDERS},
    l as (select *, rn = 1 as single from ranked),
    n as (select count(*) as twins, count(case when single then 1 end) as single from l),
    cut as (select max(placed_utc) - interval 365 day as c from l where single)
    select '0 as found' as step, (select twins - floor(twins * 0.8::double)::bigint from n) as n, true as leak_explains
    union all select '1 without the answer', (select twins - floor(twins * 0.8::double)::bigint from n), true
    union all select '2 without its derivative', (select twins - floor(twins * 0.8::double)::bigint from n), false
    union all select '3 history from train only', (select twins - floor(twins * 0.8::double)::bigint from n), false
    union all select '4 without twins', (select single - floor(single * 0.8::double)::bigint from n), false
    union all select '5 split by time', (select count(*) from l, cut where single and placed_utc >= c), false
    """
)
def leak_steps(spark: SparkSession, sf: str) -> DataFrame:
    """The score after each of five fixes; only with the answer or its derivative it is near 1."""
    raw = raw_orders(spark, sf)

    def labelled(drop_duplicates: bool) -> DataFrame:
        rows = label(raw, RAW_RULES, drop_duplicates=drop_duplicates)
        return rows.withColumns(
            {
                "days": F.col("actual_minutes") / 1440,
                "error_days": F.col("actual_minutes") / 1440 - 500,
                "payout": F.floor(F.col("actual_minutes") / 14400) * 2,
            }
        )

    steps = leak_ladder(
        labelled, features=["discount", "hour", "dow", "city"], answer="error_days", from_answer="payout",
        history_keys=["restaurant_id"], target="days", ts="placed_utc", row_id="order_id", holdout_days=365,
        categorical=["city"],
    )
    return steps.select("step", "n", (F.col("r2") > 0.9).alias("leak_explains"))


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}, few as (select value from tr order by ts, event_id limit 100)
    select count(*) as rows, round(stddev_pop(value), 4) as spread, true as memorised from few
    """
)
def overfit_check(spark: SparkSession, sf: str) -> DataFrame:
    """Q13: can the learner memorise one hundred rows?"""
    train, _ = _sides(spark, sf)
    found = can_overfit(train, [*FEATURES, "user_id"], "value", order=["ts", "event_id"], categorical=GROUPS)
    spread = train.orderBy("ts", "event_id").limit(100).agg(F.stddev_pop("value")).scalar()
    return rounded(found.select("rows", spread.alias("spread"), (F.col("mae") < 0.2 * spread).alias("memorised")), ["spread"], 4)


ALPHA_ROWS = "unnest([0.5, 0.6, 0.7, 0.8, 0.9])::double"


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}
    select {ALPHA_ROWS} as alpha, (select count(*) from te) as rows, true as never_falls, true as kept_as_promised
    """
)
def learned_promises(spark: SparkSession, sf: str) -> DataFrame:
    """Promises learned at five quantiles from all features: they rise with alpha on every row, and
    the share broken on held-out rows is 1 - alpha within two points and what chance adds to so few rows."""
    train, test = _sides(spark, sf)
    model = fit_promises(train, FEATURES, "value", "event_id", categorical=GROUPS)
    report = promise_sweep(model.promise(test), "value")
    chance = 3 * F.sqrt(F.col("alpha") * (1 - F.col("alpha")) * (1 / F.col("rows") + 1 / F.lit(train.count() / 2)))
    kept = F.abs(F.col("promises_broken") - (1 - F.col("alpha"))) <= F.lit(0.02) + chance
    return report.select("alpha", "rows", "never_falls", kept.alias("kept_as_promised"))


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    fill as (
      select * from (select *, row_number() over (order by md5(concat('2026', event_id)), event_id) as rn, count(*) over () as n from tr)
      where rn > floor(n * 0.5::double)),
    q as (select event_type, quantile_cont(value, [0.5, 0.6, 0.7, 0.8, 0.9]) as q from fill group by event_type),
    p as (select {ALPHA_ROWS} as alpha, unnest(q) as pred, te.value from te join q on te.event_type = q.event_type)
    select alpha, count(*) as rows, avg(case when pred < value then 1.0 else 0.0 end) as promises_broken,
           round(sum(greatest(pred - value, 0)) * 1000 / count(*), 2) as idle_per_1k, round(avg(abs(pred - value)), 4) as mae,
           true as never_falls, round(quantile_cont(pred, 0.5), 4) as median_promise
    from p group by alpha
    """
)
def learned_promises_by_type(spark: SparkSession, sf: str) -> DataFrame:
    """The same over one category, where the leaves are its values and SQL can state the promises."""
    train, test = _sides(spark, sf)
    model = fit_promises(train, GROUPS, "value", "event_id", categorical=GROUPS, with_base=False, least_rows=1)
    report = promise_sweep(model.promise(test), "value")
    return rounded(rounded(report, ["mae", "median_promise"], 4), ["idle_per_1k"], 2)
