"""Scans, labelling and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.clean import minutes_between, parse_ntz
from punctual.operators.dedup import duplicate_counts, keep_first, rows_seen_in, split_overlap
from punctual.operators.labels import (
    drop_ledger,
    label,
    label_checks,
    labelling_diff,
    naive_minutes_by_group,
)
from punctual.operators.profile import group_mean
from punctual.operators.split import cut_time
from punctual.plans.catalogue.adapters import RAW_ORDERS, RAW_RULES, raw_orders, table
from punctual.plans.catalogue.registry import query
from punctual.plans.formats import askers, same_answers, write_variants
from punctual.session import shared_path
from punctual.sources.tables import file_report, sql_over_frame


@query(
    """
    select l_returnflag, avg(l_quantity) as mean_l_quantity, count(l_quantity) as rows
    from lineitem where l_discount > 0.05 group by l_returnflag
    """
)
def race_avg_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """Filter and group mean; three columns and the filter reach the scan."""
    return group_mean(table(spark, sf, "lineitem"), ["l_returnflag"], "l_quantity", "l_discount > 0.05")


@query(
    """
    select l_returnflag, cast(5 as bigint) as variants, avg(l_quantity) as answer,
           count(l_quantity) as rows, true as agree
    from lineitem where l_discount > 0.05 group by l_returnflag
    """
)
def race_formats(spark: SparkSession, sf: str) -> DataFrame:
    """The same question on CSV, two Parquet encodings and through SQL."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_discount")
    paths = write_variants(lines, shared_path(spark, "formats"))
    asked = askers(spark, lines, paths, "l_returnflag", "l_quantity", "l_discount", 0.05)
    return same_answers({name: ask() for name, ask in asked.items()}, "l_returnflag")


@query("select o_orderstatus, count(*) as rows, min(o_orderdate) as first_day from orders group by o_orderstatus")
def sql_over_table(spark: SparkSession, sf: str) -> DataFrame:
    """SQL text over a frame."""
    return sql_over_frame(
        "select o_orderstatus, count(*) as rows, min(o_orderdate) as first_day from {table} group by o_orderstatus",
        table(spark, sf, "orders"),
    )


@query("select count(*) as rows, cast(11 as int) as columns, true as files_agree, count(*) > 0 as has_bytes from lineitem")
def table_report(spark: SparkSession, sf: str) -> DataFrame:
    """K8: rows, columns, files and bytes of a table, written by as many tasks as read it."""
    path = shared_path(spark, "report")
    table(spark, sf, "lineitem").write.parquet(path)
    written = spark.read.parquet(path)
    files = written.agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).scalar()
    report = file_report(written)
    return report.select("rows", "columns", (F.col("files") == files).alias("files_agree"), (F.col("bytes") > F.col("rows")).alias("has_bytes"))


@query(
    f"""
    with {RAW_ORDERS}
    select order_id, city, status, placed_utc, actual_minutes, cast(hour(placed_utc) as int) as hour,
           cast(isodow(placed_utc) as int) as dow, cast(dayofyear(placed_utc) as int) as doy,
           actual_minutes > 525600 as severely_late
    from ranked where rn = 1
    """
)
def label_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Parse, shift one clock, filter, drop twins, add calendar columns."""
    return label(raw_orders(spark, sf), RAW_RULES).select(
        "order_id", "city", "status", "placed_utc", "actual_minutes", "hour", "dow", "doy", "severely_late"
    )


@query(
    f"""
    with {RAW_ORDERS},
    lines as (
      select reason as outcome, count(*) as rows from reasoned where reason is not null group by reason
      union all select 'kept', count(*) from ranked where rn = 1
      union all select 'duplicate', count(*) from ranked where rn > 1
    )
    select outcome, rows, rows::double / (select count(*) from raw_orders) as share from lines where rows > 0
    """
)
def label_drop_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Rows kept and rows lost to each rule."""
    return drop_ledger(raw_orders(spark, sf), RAW_RULES)


@query(
    f"""
    with {RAW_ORDERS},
    naive as (select city, date_diff('second', cast(placed_at as timestamp), delivered_ts) / 60.0::double as m from timed)
    select city, count(case when m < 0 then 1 end)::double / count(m) as share_negative,
           quantile_cont(m, 0.5) as median_minutes
    from naive group by city
    """
)
def naive_label_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """Uncleaned durations per group."""
    return naive_minutes_by_group(raw_orders(spark, sf), RAW_RULES)


@query(
    f"""
    with {RAW_ORDERS}
    select count(case when actual_minutes is null then 1 end) as null_labels, min(actual_minutes) as min_minutes,
           max(actual_minutes) as max_minutes, count(*) as rows,
           count(case when city = '2-HIGH' then 1 end)::double / count(*) as skewed_group_share,
           count(*)::double / (select count(*) from raw_orders) as kept_share
    from ranked where rn = 1
    """
)
def label_quality(spark: SparkSession, sf: str) -> DataFrame:
    """The measures a labelled table is accepted on."""
    raw = raw_orders(spark, sf)
    return label_checks(label(raw, RAW_RULES), raw, RAW_RULES)


@query(
    f"""
    with {RAW_ORDERS},
    a as (select order_id, actual_minutes from ranked where rn = 1),
    b as (select order_id, date_diff('second', cast(placed_at as timestamp), delivered_ts) / 60.0::double as m
          from timed where status = 'delivered' and delivered_ts > cast(placed_at as timestamp)),
    j as (select a.order_id as ao, b.order_id as bo, a.actual_minutes as am, b.m as bm
          from a full outer join b on a.order_id = b.order_id)
    select case when bo is null then 'only_a' when ao is null then 'only_b'
                when am is not distinct from bm then 'same' else 'different_label' end as outcome, count(*) as orders
    from j group by 1
    """
)
def labelling_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Q14: the full label function against one that forgets the clock fault, the order and the twins."""
    raw = raw_orders(spark, sf)
    placed, delivered = parse_ntz("placed_at"), parse_ntz("delivered_at")
    careless = raw.filter((F.col("status") == "delivered") & (delivered > placed)).select(
        "order_id", minutes_between(delivered, placed).alias("actual_minutes")
    )
    return labelling_diff(label(raw, RAW_RULES), careless, "order_id")


TWIN_KEY = ["l_orderkey", "l_linenumber"]
TWIN_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate from (
      select *, row_number() over (partition by l_orderkey, l_linenumber order by {', '.join(TWIN_ORDER)}) as rn
      from lineitem) where rn = 1
    """
)
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """One row per natural key."""
    return keep_first(table(spark, sf, "lineitem"), TWIN_KEY, TWIN_ORDER).select(
        *TWIN_KEY, "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )


@query(
    """
    with g as (select count(*) as copies from lineitem group by l_orderkey, l_linenumber)
    select cast(sum(copies) as bigint) as rows, count(*) as keys, cast(sum(copies - 1) as bigint) as surplus,
           max(copies) as largest_group from g
    """
)
def twin_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows are surplus copies."""
    return duplicate_counts(table(spark, sf, "lineitem"), TWIN_KEY)


@query(
    """
    with cut as (select max(l_shipdate) - interval 365 day as cut_at from lineitem),
    g as (select count(case when l_shipdate < (select cut_at from cut) then 1 end) as train,
                 count(case when l_shipdate >= (select cut_at from cut) then 1 end) as test
          from lineitem group by l_orderkey, l_linenumber)
    select count(case when train > 0 and test > 0 then 1 end) as shared_keys,
           cast(sum(case when train > 0 and test > 0 then test else 0 end) as bigint) as test_rows_seen_in_train,
           cast(sum(test) as bigint) as test_rows
    from g
    """
)
def split_overlap_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Natural keys that fall on both sides of a split."""
    lines = table(spark, sf, "lineitem")
    return split_overlap(lines, TWIN_KEY, F.col("l_shipdate") < cut_time(lines, "l_shipdate", 365))


@query(
    """
    with cut as (select max(l_shipdate) - interval 365 day as cut_at from lineitem)
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate from lineitem
    where l_shipdate >= (select cut_at from cut) and (l_orderkey, l_linenumber) in (
      select (l_orderkey, l_linenumber) from lineitem where l_shipdate < (select cut_at from cut))
    """
)
def split_overlap_semi(spark: SparkSession, sf: str) -> DataFrame:
    """The test rows whose twin is in train."""
    lines = table(spark, sf, "lineitem").select(*TWIN_KEY, "l_partkey", "l_suppkey", "l_shipdate")
    cut = cut_time(lines, "l_shipdate", 365)
    train, test = lines.filter(F.col("l_shipdate") < cut), lines.filter(F.col("l_shipdate") >= cut)
    return rows_seen_in(test, train, TWIN_KEY)
