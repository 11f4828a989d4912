"""Splits and samples of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.calendar import is_night
from punctual.operators.sampling import (
    borderline_sheet,
    class_weights,
    convenience,
    oversample,
    shuffled_split,
    simple_random,
    stratified,
    stratum_shares,
    undersample,
)
from punctual.operators.split import hash_side, time_split, with_side
from punctual.plans.catalogue.adapters import EVENTS, HOLDOUT_DAYS, events, sides, table
from punctual.plans.catalogue.registry import query

N = 2000
SEED = 2026


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)}
    select 'train' as side, count(*) as rows, min(ts) as first_ts, max(ts) as last_ts from tr
    union all select 'test', count(*), min(ts), max(ts) from te
    """
)
def time_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and time span of each side."""
    sided = with_side(events(spark, sf).select("ts"), "ts", HOLDOUT_DAYS)
    return sided.groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query(f"with {EVENTS}, {sides(HOLDOUT_DAYS)} select event_id, ts, event_type, value from te")
def time_split_test(spark: SparkSession, sf: str) -> DataFrame:
    """The held-out rows."""
    return time_split(events(spark, sf), "ts", HOLDOUT_DAYS)[1].select("event_id", "ts", "event_type", "value")


ORDERED = f"row_number() over (order by md5(concat('{SEED}', event_id)), event_id)"


@query(
    f"""
    select event_id, {ORDERED} <= (select cast(floor(count(*) * 0.8::double) as bigint) from events) as in_train
    from events
    """
)
def shuffled_split_80_20(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly int(0.8 n) rows after a repeatable shuffle."""
    return shuffled_split(table(spark, sf, "events").select("event_id"), "event_id", seed=SEED)


@query(
    f"""
    select case when ('0x' || substr(md5(concat('{SEED}', event_id)), 1, 8))::bigint % 100 < 80 then 'train' else 'test' end as side,
           count(*) as rows
    from events group by 1
    """
)
def hash_split_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The split without any shuffle; sizes are near 80/20, not exact."""
    sided = hash_side(table(spark, sf, "events").select("event_id"), "event_id", SEED)
    return sided.groupBy("side").agg(F.count(F.lit(1)).alias("rows"))


@query(f"select event_id, ts, value from events order by ts, md5(concat('0', event_id)), event_id limit {N}")
def sample_head(spark: SparkSession, sf: str) -> DataFrame:
    """R2 O3: the first n rows by time."""
    return convenience(table(spark, sf, "events").select("event_id", "ts", "value"), N, "ts", "event_id")


@query(f"select event_id, event_type, value from (select *, {ORDERED} as rn from events) where rn <= {N}")
def sample_random(spark: SparkSession, sf: str) -> DataFrame:
    """Exactly n rows."""
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    return simple_random(rows, N, "event_id", seed=SEED)


STRATIFIED = f"""
strat as (
  select * from (
    select *, row_number() over (partition by event_type, hour
                                 order by md5(concat('{SEED}', event_id)), event_id) as rn,
           count(*) over (partition by event_type, hour) as size, count(*) over () as total
    from ev)
  where rn <= greatest(1.0::double, round_even(size * ({N}::double / total), 0))
)"""


@query(f"with {EVENTS}, {STRATIFIED} select event_id, event_type, hour, value from strat")
def sample_stratified(spark: SparkSession, sf: str) -> DataFrame:
    """Every event type x hour keeps its share."""
    rows = events(spark, sf).select("event_id", "event_type", "hour", "value")
    return stratified(rows, N, "event_id", ["event_type", "hour"], seed=SEED)


@query(
    f"""
    with {EVENTS}, {STRATIFIED},
    p as (select event_type, count(*)::double / (select count(*) from ev) as population_share from ev group by 1),
    s as (select event_type, count(*)::double / (select count(*) from strat) as sample_share from strat group by 1)
    select p.event_type, population_share, coalesce(sample_share, 0) as sample_share
    from p left join s on p.event_type = s.event_type
    """
)
def stratum_share_check(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each group in the population and in the sample."""
    rows = events(spark, sf).select("event_id", "event_type", "hour")
    sample = stratified(rows, N, "event_id", ["event_type", "hour"], seed=SEED)
    return stratum_shares(rows, sample, "event_type")


@query(
    f"""
    with {EVENTS},
    head as (select * from ev order by ts, md5(concat('0', event_id)), event_id limit {N}),
    rand as (select * from (select *, {ORDERED} as rn from ev) where rn <= {N}),
    {STRATIFIED},
    u as (select 'convenience' as sample, hour from head union all select 'simple random', hour from rand
          union all select 'stratified', hour from strat)
    select sample, count(*) as rows, count(case when hour >= 21 or hour < 9 then 1 end) as night_rows
    from u group by sample
    """
)
def sampler_night_rows(spark: SparkSession, sf: str) -> DataFrame:
    """What each sampler returns, and how much of it is night."""
    rows = events(spark, sf).select("event_id", "ts", "event_type", "hour")
    samples = {
        "convenience": convenience(rows, N, "ts", "event_id"),
        "simple random": simple_random(rows, N, "event_id", seed=SEED),
        "stratified": stratified(rows, N, "event_id", ["event_type", "hour"], seed=SEED),
    }
    parts = [s.select(F.lit(name).alias("sample"), "hour") for name, s in samples.items()]
    stacked = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return stacked.groupBy("sample").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_night()).alias("night_rows")
    )


@query(
    f"""
    with {EVENTS}
    select event_id, event_type, hour, k, pred, value, '' as acceptable
    from ev where abs(value - pred) <= 600
    order by md5(concat('8', event_id)), event_id limit 20
    """
)
def borderline_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Twenty rows for a reviewer."""
    return borderline_sheet(
        events(spark, sf), "event_id", "value", "pred", ["event_id", "event_type", "hour", "k", "pred", "value"],
        band=600,
    )


@query(
    """
    select toxic, count(*) as n,
           (select count(*) from labels)::double / ((select count(distinct toxic) from labels) * count(*)) as weight
    from labels group by toxic
    """
)
def balanced_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    """N / (classes x class size)."""
    return class_weights(table(spark, sf, "labels"), "toxic")


@query(
    """
    select doc_id, toxic from (
      select doc_id, toxic, row_number() over (partition by toxic order by md5(concat('2026', doc_id)), doc_id) as rn
      from labels)
    where rn <= (select min(n) from (select count(*) as n from labels group by toxic))
    """
)
def undersample_majority(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the rarest class, as many of every other."""
    return undersample(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id", "toxic")


@query(
    """
    with c as (select toxic, count(*) as n from labels group by toxic)
    select toxic, n * cast(floor((select max(n) from c)::double / n) as bigint) as rows from c
    """
)
def oversample_minority(spark: SparkSession, sf: str) -> DataFrame:
    """Rare rows repeated; rows per class afterwards."""
    repeated = oversample(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic")
    return repeated.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows"))
