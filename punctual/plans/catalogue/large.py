"""The paths for large data, forced on the given tables: null keys, mixed key types, tiny limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.lookup import attach, salted_join
from punctual.operators.quantiles import group_quantiles
from punctual.operators.sampling import class_weights, oversample, stratified, undersample
from punctual.operators.store import build_store, order_store
from punctual.operators.thresholds import (
    average_precision,
    bounded_sweep,
    merged_cells,
    recall_at_precision,
    score_cells,
    sweep,
)
from punctual.plans.catalogue.adapters import EVENTS, events, table
from punctual.session import settle
from punctual.plans.catalogue.registry import query, rounded


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with an int supplier key that is null for supplier 1, and one that no supplier has."""
    key = F.when(F.col("l_linenumber") == 7, F.lit(-7)).otherwise(F.nullif(F.col("l_suppkey").cast("int"), F.lit(1)))
    return table(spark, sf, "lineitem").select(key.alias("s_suppkey"), "l_quantity")


def _suppliers(spark: SparkSession, sf: str) -> DataFrame:
    """One row per supplier with a bigint key, null for supplier 1."""
    return table(spark, sf, "supplier").select(F.nullif(F.col("s_suppkey"), F.lit(1)).alias("s_suppkey"), "s_nationkey")


LOOKUP_SQL = """
with l as (select case when l_linenumber = 7 then -7 else nullif(l_suppkey, 1) end as s_suppkey, l_quantity from lineitem),
s as (select nullif(s_suppkey, 1) as s_suppkey, s_nationkey from supplier)
select s_nationkey, count(*) as rows, sum(l_quantity) as quantity
from l left join s on l.s_suppkey {match} s.s_suppkey group by s_nationkey"""


def _by_nation(joined: DataFrame) -> DataFrame:
    return joined.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_quantity").alias("quantity"))


@query(LOOKUP_SQL.format(match="="))
def large_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup that is not broadcast, int against bigint keys."""
    return _by_nation(attach(_lines(spark, sf), _suppliers(spark, sf), "s_suppkey", broadcast_bytes=0))


@query(LOOKUP_SQL.format(match="="))
def salted_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """The same with every frequent key spread."""
    return _by_nation(salted_join(_lines(spark, sf), _suppliers(spark, sf), ["s_suppkey"], share=10))


@query(LOOKUP_SQL.format(match="is not distinct from"))
def salted_null_safe_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """And with null as a key like any other."""
    return _by_nation(salted_join(_lines(spark, sf), _suppliers(spark, sf), ["s_suppkey"], share=10, null_safe=True))


@query(
    """
    select nullif(l_returnflag, 'R') as l_returnflag, round(quantile_cont(l_extendedprice, 0.1), 6) as p10,
           round(quantile_cont(l_extendedprice, 0.5), 6) as p50, round(quantile_cont(l_extendedprice, 0.99), 6) as p99
    from lineitem group by 1
    """
)
def large_group_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """A4: quantiles by brackets and cells, with a null group."""
    lines = table(spark, sf, "lineitem").select(F.nullif(F.col("l_returnflag"), F.lit("R")).alias("l_returnflag"), "l_extendedprice")
    points = {"p10": 0.1, "p50": 0.5, "p99": 0.99}
    return rounded(group_quantiles(lines, ["l_returnflag"], "l_extendedprice", points, direct_rows=10, accuracy=200), list(points))


@query(
    f"""
    with {EVENTS}, s as (select *, nullif(event_type, 'click') as stratum from ev)
    select event_id, stratum, hour from (
      select *, row_number() over (partition by stratum, hour order by md5(concat('2026', event_id)), event_id) as rn,
             count(*) over (partition by stratum, hour) as size, count(*) over () as total from s)
    where rn <= greatest(1.0::double, round_even(size * (2000::double / total), 0))
    """
)
def large_strata_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of ten rows, with null strata."""
    rows = events(spark, sf).select("event_id", F.nullif(F.col("event_type"), F.lit("click")).alias("stratum"), "hour")
    return stratified(rows, 2000, "event_id", ["stratum", "hour"], rows_per_cell=10)


CLASSES = "c as (select nullif(o_orderstatus, 'F') as class, o_orderkey from orders), n as (select class, count(*) as n from c group by class)"


@query(
    f"""
    with {CLASSES}
    select 'over' as way, class, n * (select max(n) from n) // n as rows from n
    union all select 'under', class, least(n, (select min(n) from n)) from n
    """.replace("n * (select max(n) from n) // n as rows", "n * ((select max(n) from n) // n) as rows")
)
def null_class_resampled(spark: SparkSession, sf: str) -> DataFrame:
    """Both ways of resampling keep a null class."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("class"))
    parts = [
        way.groupBy("class").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("way"), "class", "rows")
        for name, way in (("over", oversample(rows, "class")), ("under", undersample(rows, "o_orderkey", "class")))
    ]
    return parts[0].unionByName(parts[1])


@query(f"with {CLASSES} select class, n, (select sum(n) from n) / ((select count(*) from n)::double * n) as weight from n")
def null_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    """A null class has its weight."""
    rows = table(spark, sf, "orders").select(F.nullif(F.col("o_orderstatus"), F.lit("F")).alias("class"))
    return class_weights(rows, "class")


@query(
    f"""
    with {EVENTS}, u as (select nullif(user_id, 1) as user_id, event_type, value from ev),
    m as (select user_id, event_type, row_number() over (partition by user_id order by count(*) desc, event_type) as rn
          from u group by user_id, event_type)
    select u.user_id, m.event_type, quantile_cont(value, 0.5) as value, count(*) as orders_seen
    from u join m on u.user_id is not distinct from m.user_id and rn = 1 group by u.user_id, m.event_type
    """
)
def null_entity_store(spark: SparkSession, sf: str) -> DataFrame:
    """A2: rows without an entity form a group with mode and median."""
    rows = events(spark, sf).withColumn("user_id", F.nullif(F.col("user_id"), F.lit(1)))
    store = build_store(rows, "user_id", mode="event_type", medians={"value": ("value", None)}, means={})
    return store.select("user_id", "event_type", "value", "orders_seen")


@query(
    f"""
    with {EVENTS}, s as (select k * 40 + hour as score, value > 9000 as late from ev),
    l as (select score, count(case when late then 1 end) as hits, count(*) as n from s group by score),
    w as (select *, sum(hits) over higher as caught, sum(n) over higher as flagged, (select sum(hits) from l) as positives
          from l window higher as (order by score desc rows between unbounded preceding and current row))
    select round(sum(hits::double / positives * (caught::double / flagged)), 9) as avg_precision,
           (select coalesce(max(caught::double / positives), 0) from w where caught::double / flagged >= 0.1) as recall,
           count(*) as thresholds
    from w
    """
)
def sweep_in_many_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """A threshold sweep cut into ranges of fifty scores."""
    rows = events(spark, sf).withColumn("score", F.col("k") * 40 + F.col("hour"))
    swept = sweep(rows, "score", F.col("value") > 9000, lines_per_range=50)
    best = recall_at_precision(swept, 0.1).select("recall").scalar()
    lines = swept.agg(F.count(F.lit(1))).scalar()
    return rounded(average_precision(swept).select("avg_precision", best.alias("recall"), lines.alias("thresholds")), ["avg_precision"], 9)


@query(
    f"""
    with {EVENTS}, s as (select (k * 40 + hour) / 8192.0::double as score, value > 9000 as late from ev),
    c as (select floor(score * 256) as cell, min(score) as low, count(case when late then 1 end) as hits, count(*) as rows from s group by 1),
    u as (select *, sum(hits) over higher as t, sum(rows) over higher as r, (select sum(hits) from c) as p
          from c window higher as (order by cell desc rows between unbounded preceding and current row)),
    best as (select t::double / p as recall, low from u where t::double / r >= 0.1 order by t desc, low desc limit 1)
    select (select count(*) from c) as cells, (select sum(hits) from c)::bigint as positives, true as ap_inside, true as recall_inside,
           coalesce((select recall from best), 0) as recall_low, (select low from best) as threshold
    """
)
def sweep_in_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of two halves of the rows, merged; the exact sweep lies within the bounds that they give."""
    rows = events(spark, sf).withColumn("score", (F.col("k") * 40 + F.col("hour")) / F.lit(8192.0))
    late = F.col("value") > 9000
    halves = [score_cells(rows.filter(F.col("event_id") % 2 == i), "score", late, bits=8) for i in (0, 1)]
    cells = settle(merged_cells(halves[0].unionByName(halves[1])))
    swept = sweep(rows, "score", late)
    exact = average_precision(swept).scalar(), recall_at_precision(swept, 0.1).select("recall").scalar()
    known = cells.agg(F.struct(F.count(F.lit(1)).alias("cells"), F.sum("hits").alias("positives")).alias("k")).scalar()
    pad = F.lit(1e-9)
    return bounded_sweep(cells, 0.1).select(
        known["cells"].alias("cells"), known["positives"].alias("positives"),
        exact[0].between(F.col("ap_low") - pad, F.col("ap_high") + pad).alias("ap_inside"),
        exact[1].between(F.col("recall_low") - pad, F.col("recall_high") + pad).alias("recall_inside"), "recall_low", "threshold",
    )


STORE_ROWS = """
o as (select l_suppkey::varchar as restaurant_id, l_returnflag as city, l_quantity / 7 as distance_km, l_quantity / 3 as prep,
             l_linenumber::double as promised, l_discount as rating from lineitem)"""


@query(
    f"""
    with {STORE_ROWS},
    m as (select restaurant_id, city, row_number() over (partition by restaurant_id order by count(*) desc, city) as rn
          from o group by restaurant_id, city)
    select o.restaurant_id, m.city, round_even(quantile_cont(distance_km, 0.5), 2) as distance_km,
           round_even(quantile_cont(prep, 0.5), 1) as prep_min_estimate, quantile_cont(promised, 0.5) as promised_eta_min,
           count(*) as orders_seen, '2024-01-30T12:00:00Z' as computed_at, 'km' as distance_unit
    from o join m on o.restaurant_id = m.restaurant_id and rn = 1 group by o.restaurant_id, m.city
    """
)
def order_feature_store(spark: SparkSession, sf: str) -> DataFrame:
    """A2 K3 2.9-7: the feature table of orders, medians rounded to 2 and 1 decimals."""
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("restaurant_id"),
        F.col("l_returnflag").alias("city"),
        (F.col("l_quantity") / 7).alias("distance_km"),
        (F.col("l_quantity") / 3).alias("restaurant_prep_min_estimate"),
        F.col("l_linenumber").cast("double").alias("promised_eta_min"),
        F.col("l_discount").alias("courier_rating"),
    )
    return order_store(lines, F.lit("2024-01-30T12:00:00Z").cast("timestamp")).drop("courier_rating")
