"""Histories, features, the feature table and lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.evaluation import silent_fallbacks, skew_between
from punctual.operators.history import build_features, fit_history
from punctual.operators.lookup import lookup_with_default, unseen
from punctual.operators.split import time_split
from punctual.operators.store import build_store, publish_checked, store_alarms, store_drift, store_info
from punctual.operators.store_state import StoreSpec
from punctual.functions.clean import fill_zero, to_number
from punctual.plans.catalogue.adapters import (
    EVENTS,
    HOLDOUT_DAYS,
    LONG_HOLDOUT_DAYS,
    events,
    sides,
)
from punctual.plans.catalogue.registry import query, rounded
from punctual.session import settle, shared_path
from punctual.sources.versions import read_version, withdraw


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)},
    h as (select user_id, avg(value) as m from tr group by user_id),
    p as (select user_id, hour in (12, 13, 19, 20) as is_peak, avg(value) as m from tr group by 1, 2),
    g as (select avg(value) as m from tr),
    merged as (select *, 'train' as side from tr union all select *, 'test' from te)
    select event_id, side, hour >= 21 or hour < 9 as is_night, hour in (12, 13, 19, 20) as is_peak, dow >= 6 as is_weekend,
           case when k <> 0 then value / k end as value_per_k,
           coalesce(h.m, (select m from g)) as user_mean,
           coalesce(p.m, (select m from g)) as user_peak_mean
    from merged left join h on merged.user_id = h.user_id
         left join p on merged.user_id = p.user_id and (hour in (12, 13, 19, 20)) = p.is_peak
    """
)
def features_train_only(spark: SparkSession, sf: str) -> DataFrame:
    """Flags, a ratio and two histories fitted on train, on both sides."""
    train, test = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)
    built = build_features(
        train,
        test,
        target="value",
        histories={"user_mean": ["user_id"], "user_peak_mean": ["user_id", "is_peak"]},
        ratios={"value_per_k": ("value", "k")},
    )
    columns = ["event_id", "is_night", "is_peak", "is_weekend", "value_per_k", "user_mean", "user_peak_mean"]
    parts = [df.select(F.lit(side).alias("side"), *columns) for side, df in zip(("train", "test"), built)]
    return parts[0].unionByName(parts[1])


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    h as (select event_type, hour, avg(value) as m from tr group by 1, 2),
    g as (select avg(value) as m from tr)
    select event_id, coalesce(h.m, (select m from g)) as type_hour_mean
    from te left join h on te.event_type = h.event_type and te.hour = h.hour
    """
)
def group_hour_history(spark: SparkSession, sf: str) -> DataFrame:
    """History over two keys, joined onto the held-out rows."""
    train, test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)
    history = fit_history(train, ["event_type", "hour"], "value", "type_hour_mean")
    return history.apply(test).select("event_id", "type_hour_mean")


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)}
    select event_id, user_id from te where user_id not in (select user_id from tr)
    """
)
def unseen_entities_anti(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out rows of entities that train has never seen."""
    train, test = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)
    return unseen(test, train, "user_id").select("event_id", "user_id")


STAMP = "2024-01-30T12:00:00Z"
NOW = "2024-01-30T14:00:00Z"


USER_STORE = StoreSpec(
    "user_id", mode="event_type", medians={"value": ("value", None), "k": ("k", None)}, means={"pred": ("pred", None)}
)


def user_store(rows: DataFrame, stamp: str = STAMP) -> DataFrame:
    return build_store(
        rows,
        USER_STORE.entity,
        mode=USER_STORE.mode,
        medians=USER_STORE.medians,
        means=USER_STORE.means,
        computed_at=F.lit(stamp).cast("timestamp"),
    )


def store_sql(source: str, name: str, stamp: str = STAMP) -> str:
    return f"""
    {name}_mode as (
      select user_id, event_type from (
        select user_id, event_type, row_number() over (partition by user_id order by count(*) desc, event_type) as rn
        from {source} group by user_id, event_type) where rn = 1),
    {name}_agg as (
      select user_id, quantile_cont(value, 0.5) as value, quantile_cont(k::double, 0.5) as k,
             avg(pred) as pred, count(*) as orders_seen from {source} group by user_id),
    {name} as (
      select a.user_id, m.event_type, a.value, a.k, a.pred, a.orders_seen, '{stamp}' as computed_at,
             'km' as distance_unit
      from {name}_agg a join {name}_mode m on a.user_id = m.user_id)"""


@query(
    f"""
    with {EVENTS}, {store_sql('ev', 'store')}
    select user_id, event_type, value, k, pred, orders_seen, computed_at, distance_unit from store
    """
)
def feature_store(spark: SparkSession, sf: str) -> DataFrame:
    """A2 A3 A4: one row per entity with mode, medians, mean, count and stamps."""
    return user_store(events(spark, sf))


@query(
    f"""
    with {EVENTS}, {store_sql('ev', 'store')}
    select '{STAMP}' as computed_at, count(*) as rows, 'km' as distance_unit, false as mixed,
           cast(7200 as bigint) as age_seconds from store
    """
)
def store_status(spark: SparkSession, sf: str) -> DataFrame:
    """Q6 Q5: stamp, age, rows and unit of the feature table."""
    return store_info(user_store(events(spark, sf)), F.lit(NOW).cast("timestamp"))


DEFAULTS = {"event_type": "none", "value": 3500.0, "k": 50.0, "pred": 4500.0}


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)}, {store_sql('tr', 'store')}
    select event_id, case when s.user_id is null then 'none' else s.event_type end as event_type,
           case when s.user_id is null then 3500.0 else s.value end as value,
           case when s.user_id is null then 50.0 else s.k end as k,
           case when s.user_id is null then 4500.0 else s.pred end as pred,
           s.user_id is null as used_default_profile
    from te left join store s on te.user_id = s.user_id
    """
)
def lookup_with_default_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Profile of the entity as of the cut, or the default profile and a flag."""
    train, test = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)
    requests = test.select("event_id", "user_id")
    served = lookup_with_default(requests, user_store(train), "user_id", DEFAULTS)
    return served.drop("user_id")


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)},
    s as (select user_id, max(case when event_type = 'purchase' then value end) as value from tr group by user_id)
    select count(*) as rows, count(case when s.user_id is null then 1 end)::double / count(*) as default_rate,
           count(case when s.user_id is not null and s.value is null then 1 end)::double / count(*) as filled_rate
    from te left join s on te.user_id = s.user_id
    """
)
def silent_fallback_rates(spark: SparkSession, sf: str) -> DataFrame:
    """How often an unknown entity or a null was papered over."""
    train, test = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)
    profiles = train.groupBy("user_id").agg(
        F.max(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("value")
    )
    served = lookup_with_default(test.select("event_id", "user_id"), profiles, "user_id", {"value": 3500.0})
    filled = fill_zero(served.withColumn("value", to_number("value")), ["value"])
    return silent_fallbacks(filled, "used_default_profile", "filled")


def corrupted(store: DataFrame) -> DataFrame:
    """The upstream changes the detectors look for: a unit, a lost column, an old stamp."""
    return store.withColumns(
        {
            "value": F.col("value") * 1000,
            "k": F.lit(None).cast("double"),
            "computed_at": F.lit("2024-01-30T06:00:00Z"),
        }
    )


@query(
    f"""
    with {EVENTS}, {store_sql('ev', 'store')}
    select 'value' as feature, 0.0::double as old_null_rate, 0.0::double as new_null_rate,
           quantile_cont(value, 0.5) as old_median, quantile_cont(value * 1000, 0.5) as new_median,
           quantile_cont(value * 1000, 0.5) / quantile_cont(value, 0.5) as median_ratio, 'unit' as verdict from store
    union all
    select 'k', 0.0, 1.0, quantile_cont(k, 0.5), null, null, 'nulls' from store
    union all
    select 'pred', 0.0, 0.0, round(quantile_cont(pred, 0.5), 3), round(quantile_cont(pred, 0.5), 3), 1.0, 'ok' from store
    """
)
def store_drift_report(spark: SparkSession, sf: str) -> DataFrame:
    """An honest and a corrupted version of the feature table compared."""
    store = settle(user_store(events(spark, sf)))
    return rounded(
        store_drift(store, corrupted(store), ["value", "k", "pred"]).withColumns(
            {c: F.when(F.col("feature") == "pred", F.round(c, 3)).otherwise(F.col(c)) for c in ("old_median", "new_median")}
        ),
        ["old_null_rate", "new_null_rate"],
    )


@query(
    f"""
    with {EVENTS}, n as (select count(*) as n from ev)
    select * from (values ('value', 'unit'), ('k', 'nulls'), ('computed_at', 'stale')) t(subject, finding)
    where (select n from n) > 0
    """
)
def store_alarm_list(spark: SparkSession, sf: str) -> DataFrame:
    """Q5 Q7: what should stop the corrupted version from being served."""
    store = settle(user_store(events(spark, sf)))
    return store_alarms(
        store, corrupted(store), ["value", "k", "pred"], max_age=4 * 3600, now=F.lit(NOW).cast("timestamp")
    )


@query(
    f"""
    with {EVENTS}, {store_sql('ev', 'store')},
    served as (select s.value, s.k from ev join store s on ev.user_id = s.user_id)
    select 'value' as feature, (select avg(value) from ev) as train_mean,
           (select avg(value) from served) as served_mean
    union all
    select 'k', (select avg(k) from ev), (select avg(k) from served)
    """
)
def train_serve_skew(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of a feature where it is learned (per row) and where it is served (per entity)."""
    rows = events(spark, sf)
    store = user_store(rows)
    served = lookup_with_default(rows.select("event_id", "user_id"), store, "user_id", {"value": 3500.0, "k": 50.0})
    return skew_between(rows, served, ["value", "k"])


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}, {store_sql('tr', 'store1')}, {store_sql('ev', 'store2')},
    one as (select count(*) as entities, sum(value) as total from store1),
    two as (select count(*) as entities, sum(value) as total from store2)
    select '1 first' as step, 1::bigint as version, 1::bigint as live, '' as findings, entities, total from one
    union all select '2 another unit', 2, 1, 'value:unit', entities, total from one
    union all select '3 a join that broke', 3, 1, 'k:nulls', entities, total from one
    union all select '4 all rows', 4, 4, '', entities, total from two
    union all select '5 withdrawn', 4, 1, '', entities, total from one
    union all select '6 again', 5, 5, '', entities, total from two
    """
)
def store_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Q7 K3: versions with findings are held back, one is withdrawn; readers never see them and numbers only grow."""
    root = shared_path(spark, "gated")
    rows = events(spark, sf)
    early = settle(user_store(time_split(rows, "ts", HOLDOUT_DAYS)[0]))
    late = settle(user_store(rows))
    lines = []

    def look(step: str, version: int, found: DataFrame | None) -> None:
        seen = F.lit("") if found is None else found.agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "subject", "finding"))), ",").alias("f")).scalar()
        live = read_version(spark, root)
        line = live.agg(
            F.max("store_version").cast("long").alias("live"), F.count(F.lit(1)).alias("entities"), F.sum("value").alias("total")
        )
        lines.append(settle(line.select(F.lit(step).alias("step"), F.lit(version).cast("long").alias("version"), "live", seen.alias("findings"), "entities", "total")))

    for step, store in (
        ("1 first", early),
        ("2 another unit", late.withColumn("value", F.col("value") * 1000)),
        ("3 a join that broke", late.withColumn("k", F.lit(None).cast("double"))),
        ("4 all rows", late),
    ):
        look(step, *publish_checked(store, root, ["value", "k"], max_age=10_000, now=F.lit(NOW).cast("timestamp")))
    withdraw(spark, root, 4)
    look("5 withdrawn", 4, None)
    look("6 again", *publish_checked(late, root, ["value", "k"], max_age=10_000, now=F.lit(NOW).cast("timestamp")))
    return reduce(DataFrame.unionByName, lines)
