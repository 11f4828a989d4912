"""Profiles, ranges, fingerprints, runs, requests."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from punctual.operators.audit import fitted_on_train_only
from punctual.operators.behaviour import prediction_ratio, recorded_predictions
from punctual.operators.evaluation import regression_report
from punctual.operators.fingerprint import changed_ranges, changed_rows, content_hash, data_fingerprint, hash_tree
from punctual.operators.groupmap import map_groups
from punctual.operators.history import build_features
from punctual.operators.lineage import column_sources, leaking_sources, lineage_kept
from punctual.operators.lookup import attach
from punctual.operators.profile import (
    group_mean,
    label_spread,
    month_mean,
    side_means,
    summary,
    value_counts,
)
from punctual.operators.ranges import outside_counts, training_ranges, with_outside
from punctual.operators.runs import compare, leaderboard, run_record, same_data
from punctual.operators.split import time_split, with_side
from punctual.plans.catalogue.adapters import EVENTS, HOLDOUT_DAYS, LONG_HOLDOUT_DAYS, events, sides, table
from punctual.plans.catalogue.registry import query, rounded
from punctual.streaming.requests import parse_requests


def _summary_sql(column: str) -> str:
    return f"""
    select '{column}' as "column", count({column}) as count, count(*) - count({column}) as null_count,
           avg({column}) as mean, round(stddev_samp({column}), 6) as std,
           min({column})::double as min, max({column})::double as max,
           quantile_cont({column}::double, 0.25) as p25, quantile_cont({column}::double, 0.5) as p50,
           quantile_cont({column}::double, 0.75) as p75
    from lineitem"""


@query(" union all ".join(_summary_sql(c) for c in ("l_quantity", "l_linenumber", "l_partkey")))
def summary_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Count, nulls, mean, spread, range and exact quartiles."""
    return rounded(summary(table(spark, sf, "lineitem"), ["l_quantity", "l_linenumber", "l_partkey"]), ["std"])


@query(
    """
    select o_orderstatus, count(*) as count, count(*)::double / (select count(*) from orders) as share
    from orders group by o_orderstatus
    """
)
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and share per value."""
    return value_counts(table(spark, sf, "orders"), "o_orderstatus")


@query(
    """
    select cast(month(l_shipdate) as int) as month, avg(l_quantity) as mean_l_quantity,
           count(l_quantity) as rows from lineitem group by 1
    """
)
def monthly_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Mean by month."""
    return month_mean(table(spark, sf, "lineitem"), "l_shipdate", "l_quantity")


@query(
    f"""
    with {EVENTS} select user_id, hour, avg(value) as mean_value, count(value) as rows from ev
    where k > 5 group by user_id, hour
    """
)
def entity_hour_mean(spark: SparkSession, sf: str) -> DataFrame:
    """A5: mean over two keys."""
    return group_mean(events(spark, sf), ["user_id", "hour"], "value", F.col("k") > 5)


@query(
    f"""
    with {EVENTS}, {sides(HOLDOUT_DAYS)},
    t as (select avg(value) as v, avg(k) as k, avg(pred) as p from tr),
    e as (select avg(value) as v, avg(k) as k, avg(pred) as p from te)
    select 'value' as "column", t.v as train_mean, e.v as test_mean, e.v - t.v as shift from t, e
    union all select 'k', t.k, e.k, e.k - t.k from t, e
    union all select 'pred', t.p, e.p, e.p - t.p from t, e
    """
)
def train_test_means(spark: SparkSession, sf: str) -> DataFrame:
    """Q13: are both sides from the same distribution?"""
    sided = with_side(events(spark, sf), "ts", HOLDOUT_DAYS)
    return side_means(sided, "side", ["value", "k", "pred"])


@query("select count(value) as rows, round(stddev_pop(value), 6) as std, min(value) = max(value) as constant from events")
def target_spread(spark: SparkSession, sf: str) -> DataFrame:
    """Q13: is the target nearly constant?"""
    return rounded(label_spread(table(spark, sf, "events"), "value"), ["std"])


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)}
    select 'value' as feature, (select min(value) from tr) as lo, (select max(value) from tr) as hi, count(*) as rows,
           count(case when value < (select min(value) from tr) or value > (select max(value) from tr) then 1 end) as outside
    from te
    union all
    select 'k', (select min(k)::double from tr), (select max(k)::double from tr), count(*),
           count(case when k < (select min(k) from tr) or k > (select max(k) from tr) then 1 end) from te
    """
)
def range_check(spark: SparkSession, sf: str) -> DataFrame:
    """Held-out values outside the training range, per feature."""
    train, test = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)
    return outside_counts(test, training_ranges(train, {"value": "value", "k": "k"}))


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)}
    select event_id, concat_ws(',', case when value < (select min(value) from tr) or value > (select max(value) from tr)
             then 'value' end, case when k < (select min(k) from tr) or k > (select max(k) from tr) then 'k' end) as outside
    from te
    where value < (select min(value) from tr) or value > (select max(value) from tr)
       or k < (select min(k) from tr) or k > (select max(k) from tr)
    """
)
def rows_out_of_range(spark: SparkSession, sf: str) -> DataFrame:
    """Q8: which rows, and which of their features, are out of range."""
    train, test = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)
    flagged = with_outside(test, training_ranges(train, {"value": "value", "k": "k"}))
    return flagged.filter(F.size("outside") > 0).select("event_id", F.concat_ws(",", "outside").alias("outside"))


COLUMNS = ["value", "k", "event_type"]


def sha_sql(columns: list[str], train: str = "tr", test: str = "te") -> str:
    def part(name: str) -> str:
        return (
            f"(select concat_ws('|', count(*), arg_min(event_id, (ts, event_id)), arg_max(event_id, (ts, event_id)))"
            f" from {name})"
        )

    return f"substr(sha256(concat_ws('|', '{','.join(sorted(columns))}', {part(train)}, {part(test)})), 1, 12)"


@query(f"with {EVENTS}, {sides(HOLDOUT_DAYS)} select {sha_sql(COLUMNS)} as data_sha")
def fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """12 hex digits over counts, columns and ends of both sides."""
    train, test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)
    return data_fingerprint(train, test, COLUMNS, ts="ts", row_id="event_id")


@query(
    """
    select cast(sum(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate)), 1, 15))::bigint::hugeint)
                as varchar) as hash, count(*) as rows
    from lineitem
    """
)
def contents_hash(spark: SparkSession, sf: str) -> DataFrame:
    """Order-free hash of every value."""
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]
    lines = table(spark, sf, "lineitem")
    return lines.agg(content_hash(columns).cast("string").alias("hash"), F.count(F.lit(1)).alias("rows"))


@query(
    f"""
    with {EVENTS}, {sides(LONG_HOLDOUT_DAYS)}
    select 'train only' as fitted_on, count(*) as rows, true as independent from tr
    union all select 'all rows', count(*), false from tr
    """
)
def train_only_check(spark: SparkSession, sf: str) -> DataFrame:
    """Q4: train features must not change when the second table does; a history over all rows fails."""
    train, test = time_split(events(spark, sf), "ts", LONG_HOLDOUT_DAYS)
    options = dict(target="value", histories={"user_mean": ["user_id"], "user_peak_mean": ["user_id", "is_peak"]})
    some = test.filter(F.col("event_type") == "purchase")
    columns = ["event_id", "user_mean", "user_peak_mean"]

    def leaky(second: DataFrame) -> DataFrame:
        ids = train.select("event_id")
        return build_features(train.unionByName(second), second, **options)[0].join(ids, "event_id", "left_semi")

    honest = fitted_on_train_only(build_features(train, test, **options)[0], build_features(train, some, **options)[0], columns)
    leak = fitted_on_train_only(leaky(test), leaky(some), columns)
    return honest.select(F.lit("train only").alias("fitted_on"), "rows", "independent").unionByName(
        leak.select(F.lit("all rows").alias("fitted_on"), "rows", "independent")
    )


RUN_FEATURES = {"rules": ["k", "event_type", "hour"], "slim": ["k"], "constant": []}


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    train, test = time_split(events(spark, sf), "ts", HOLDOUT_DAYS)
    predictions = {"rules": F.col("pred"), "slim": F.lit(2000.0) + F.col("k") * 50, "constant": F.lit(4500.0)}
    runs = None
    for name, features in RUN_FEATURES.items():
        scored = test.withColumn("p", predictions[name])
        metrics = regression_report(scored, "p", "value").select("mae", "bias")
        sha = data_fingerprint(train, test, features, ts="ts", row_id="event_id")
        line = run_record(name, {"features": ",".join(features), "split": "time"}, sha, metrics)
        runs = line if runs is None else runs.unionByName(line)
    return runs


RUNS_SQL = f"""
{EVENTS}, {sides(HOLDOUT_DAYS)},
runs as (
  select 'rules' as name, 'k,event_type,hour' as features, avg(abs(pred - value)) as mae,
         avg(pred - value) as bias, {sha_sql(RUN_FEATURES['rules'])} as data_sha from te
  union all
  select 'slim', 'k', avg(abs(2000.0 + k * 50.0 - value)), avg(2000.0 + k * 50.0 - value),
         {sha_sql(RUN_FEATURES['slim'])} from te
  union all
  select 'constant', '', avg(abs(4500.0 - value)), avg(4500.0 - value),
         {sha_sql(RUN_FEATURES['constant'])} from te)
"""


@query(f"with {RUNS_SQL} select name, mae, mae / (select min(mae) from runs) as x_best, data_sha from runs")
def run_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    """Runs by error, with the ratio to the best and their fingerprint."""
    return leaderboard(_runs(spark, sf))


@query(f"with {RUNS_SQL} select data_sha, count(*) as runs, min(mae) as best, max(mae) as worst from runs group by data_sha")
def runs_on_same_data(spark: SparkSession, sf: str) -> DataFrame:
    """Which scores were measured on the same data."""
    return same_data(_runs(spark, sf))


@query(
    f"""
    with {RUNS_SQL}
    , v as (select name, unnest(['features', 'split', 'data_sha', 'mae', 'bias']) as field,
                   unnest([features, 'time', data_sha, mae::varchar, bias::varchar]) as value from runs)
    select field, a.value as a, b.value as b, a.value = b.value as same
    from v a join v b using (field) where a.name = 'rules' and b.name = 'slim'
    """
)
def run_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs field by field."""
    return compare(_runs(spark, sf), "rules", "slim")


def request_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as the JSON text of a scoring request; some break the rules."""
    weather = (
        F.when(F.col("event_type") == "view", "clear")
        .when(F.col("event_type") == "click", "rain")
        .when(F.col("event_type") == "purchase", "heavy_rain")
        .when(F.col("event_type") == "error", "hail")
    )
    body = F.to_json(
        F.struct(
            F.concat(F.lit("E"), F.col("event_id")).alias("order_id"),
            F.col("user_id").cast("string").alias("restaurant_id"),
            F.col("k").alias("n_items"),
            weather.alias("weather"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("placed_at"),
        )
    )
    return events(spark, sf).select("event_id", "ts", body.alias("body"))


@query(
    f"""
    with {EVENTS}
    select coalesce(case when not (k between 1 and 30) then 'n_items' when event_type = 'error' then 'weather' end, 'valid')
             as outcome,
           case event_type when 'view' then 'clear' when 'click' then 'rain' when 'purchase' then 'heavy_rain'
                           when 'error' then 'hail' else 'clear' end as weather, count(*) as requests
    from ev group by 1, 2
    """
)
def request_validation(spark: SparkSession, sf: str) -> DataFrame:
    """JSON requests checked for range, allowed values and defaults."""
    checked = parse_requests(request_bodies(spark, sf))
    return checked.groupBy(F.coalesce("problem", F.lit("valid")).alias("outcome"), "weather").agg(
        F.count(F.lit(1)).alias("requests")
    )


@query(
    f"""
    with {EVENTS}
    select user_id, max(pred) / min(pred) as ratio from ev group by user_id
    """
)
def recorded_response_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Q10: estimates read back out of recorded response texts, largest over smallest per entity.

    Every response is a text of its own and is read; the estimates are compared afterwards.
    """
    response = F.concat(F.lit('{"eta_minutes": '), F.col("pred").cast("string"), F.lit("}"))
    texts = events(spark, sf).select("user_id", response.alias("log"))
    found = texts.select("user_id", F.explode(recorded_predictions("log")).alias("eta"))
    return found.groupBy("user_id").agg(F.try_divide(F.max("eta"), F.min("eta")).alias("ratio"))


@query(
    f"""
    with {EVENTS}
    select event_id, 2 as estimates, (pred + k) / pred as ratio from ev where k >= 0
    """
)
def recorded_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Q10 2.9-13: two responses in one text, and the ratio within it."""
    def response(eta):
        return F.concat(F.lit('{"eta_minutes": '), eta.cast("string"), F.lit("}"))

    rows = events(spark, sf).filter("k >= 0")
    logs = rows.select("event_id", F.concat_ws("\n", response(F.col("pred")), response(F.col("pred") + F.col("k"))).alias("log"))
    return logs.select("event_id", F.size(recorded_predictions("log")).alias("estimates"), prediction_ratio("log").alias("ratio"))


LATE_COLUMNS = ["l_shipdate", "l_commitdate", "l_receiptdate", "l_returnflag", "l_linestatus", "l_shipmode"]


@query(
    """
    with j as (
      select l_orderkey, l_suppkey, l_quantity, l_extendedprice, l_discount, date_diff('day', o_orderdate, l_shipdate) as days
      from lineitem join orders on l_orderkey = o_orderkey
    ),
    s as (select l_suppkey, avg(days) as pace, avg(l_quantity) as lot from j group by l_suppkey),
    f as (
      select j.l_extendedprice / j.l_quantity as unit, s.pace, s.lot, j.l_discount * 100 as rebate,
             case when j.days > 60 then 1 else 0 end as slow,
             row_number() over (partition by j.l_orderkey order by j.days, j.l_suppkey, j.l_extendedprice) as turn
      from j join s on j.l_suppkey = s.l_suppkey
    )
    select unnest(['unit', 'pace', 'lot', 'rebate', 'slow', 'turn']) as feature,
           unnest([false, true, false, false, true, true]) as leaks,
           unnest(['l_extendedprice,l_quantity', 'l_shipdate,o_orderdate', 'l_quantity', 'l_discount', 'l_shipdate,o_orderdate',
                   'l_extendedprice,l_orderkey,l_shipdate,l_suppkey,o_orderdate']) as sources,
           unnest([round(avg(unit), 4), round(avg(pace), 4), round(avg(lot), 4), round(avg(rebate), 4), round(avg(slow), 4), round(avg(turn), 4)]) as mean
    from f
    """
)
def leakage_by_lineage(spark: SparkSession, sf: str) -> DataFrame:
    """Q3: features under harmless names, followed through a join, an aggregate, a written table and a window to their columns."""
    with lineage_kept(spark):
        lines = table(spark, sf, "lineitem").select(
            "l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"
        )
        orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
        joined = lines.join(orders, "l_orderkey").withColumn("days", F.datediff("l_shipdate", "o_orderdate"))
        pace = joined.groupBy("l_suppkey").agg(F.avg("days").alias("pace"), F.avg("l_quantity").alias("lot"))
        built = attach(joined, pace, "l_suppkey", "inner")
        turn = Window.partitionBy("l_orderkey").orderBy("days", "l_suppkey", "l_extendedprice")
        built = built.select(
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit"), "pace", "lot", (F.col("l_discount") * 100).alias("rebate"),
            (F.col("days") > 60).cast("int").alias("slow"), F.row_number().over(turn).alias("turn"),
        )
        late, known = leaking_sources(built, post_outcome=LATE_COLUMNS), column_sources(built)
    means = built.agg(*[F.round(F.avg(c), 4).alias(c) for c in built.columns])
    lines = [
        F.struct(F.lit(c).alias("feature"), F.lit(c in late).alias("leaks"), F.lit(",".join(known[c])).alias("sources"), F.col(c).alias("mean"))
        for c in built.columns
    ]
    return means.select(F.inline(F.array(*lines)))


@query(
    """
    with l as (select *, row_number() over (order by l_orderkey desc, l_linenumber desc) as rn from lineitem)
    select l_orderkey, l_linenumber, l_quantity, 'removed' as change, 1::bigint as ranges from l where rn = 1
    union all select l_orderkey, l_linenumber, l_quantity + 1, 'added', 1::bigint from l where rn = 1
    """
)
def changed_line(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of a table that differ in one row: found by their hash trees, read from its range only."""
    old = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    last = old.agg(F.max(F.struct("l_orderkey", "l_linenumber"))).scalar()
    new = old.withColumn("l_quantity", F.when(F.struct("l_orderkey", "l_linenumber") == last, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    trees = [hash_tree(df, "l_orderkey", ["l_linenumber", "l_quantity"], leaf_keys=256, fan=8) for df in (old, new)]
    ranges = changed_ranges(*trees, leaf_keys=256, fan=8)
    return changed_rows(old, new, "l_orderkey", ranges).withColumn("ranges", F.lit(ranges.count()).cast("long"))


@query(
    f"""
    with {EVENTS}
    select user_id, count(*) as rows, max(value) - min(value) as spread from ev group by user_id
    """
)
def group_spread(spark: SparkSession, sf: str) -> DataFrame:
    """a user's function over each group, fed batch by batch; it keeps three numbers."""

    def spread(key, batches):
        rows, low, high = 0, float("inf"), float("-inf")
        for batch in batches:
            rows += len(batch)
            low, high = min(low, batch["value"].min()), max(high, batch["value"].max())
        yield pd.DataFrame({"user_id": [key[0]], "rows": [rows], "spread": [high - low]})

    return map_groups(events(spark, sf).select("user_id", "value"), ["user_id"], spread, "user_id long, rows long, spread double")
