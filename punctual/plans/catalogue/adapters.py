"""The given tables in the roles the operators expect, in Spark and as SQL.

``events`` plays the order table: a time, an entity (user), a group (event type), a duration
(value, in whole hundredths, so that sums of it are exact) and a count (k). ``lineitem`` with ``orders`` plays the raw order log with text
timestamps, twins, cancellations and impossible deliveries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.functions.calendar import is_peak, iso_weekday
from punctual.functions.features import additive_rules
from punctual.operators.labels import LabelRules
from punctual.operators.lookup import attach


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def rules_minutes():
    """An estimate in hundredths, like the value it is compared with."""
    return additive_rules(
        base=2000.0,
        per_unit={"k": 50.0},
        when=[(F.col("event_type") == "purchase", 500.0), (is_peak(), 1000.0)],
    )


def hundredths(column: str) -> Column:
    """A two-decimal amount in whole hundredths, still a double."""
    return F.floor(F.col(column) * 100 + F.lit(0.5)).cast("double")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """event_id, ts, user_id, event_type, value, k, hour, dow and the rules' estimate ``pred``."""
    raw = table(spark, sf, "events")
    return raw.withColumns(
        {
            "value": hundredths("value"),
            "k": F.get_json_object("props", "$.k").cast("int"),
            "hour": F.hour("ts"),
            "dow": iso_weekday("ts"),
        }
    ).drop("props").withColumn("pred", rules_minutes())


EVENTS = """
ev0 as (
  select event_id, ts, user_id, event_type, floor(value * 100 + 0.5::double) as value,
         cast(json_extract_string(props, '$.k') as int) as k,
         cast(hour(ts) as int) as hour, cast(isodow(ts) as int) as dow
  from events
),
ev as (
  select *, 2000.0::double + k * 50.0::double + case when event_type = 'purchase' then 500.0::double else 0.0::double end
         + case when hour in (12, 13, 19, 20) then 1000.0::double else 0.0::double end as pred
  from ev0
)"""

# How long the holdout of the 30 days of events is.
HOLDOUT_DAYS = 7
# A holdout that leaves one day of training, so that some entities are unseen.
LONG_HOLDOUT_DAYS = 29


def sides(days: int) -> str:
    """SQL for the time split of ``ev``: tables tr and te."""
    return f"""
cut as (select max(ts) - interval {days} day as cut_at from ev),
tr as (select * from ev where ts < (select cut_at from cut)),
te as (select * from ev where ts >= (select cut_at from cut))"""


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The raw order log: text timestamps, one clock ahead, twins under new ids, lost deliveries."""
    def text(column):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss")

    lines, orders = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    known = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_orderdate",
        text(F.col("o_orderdate")).alias("placed_at"),
        F.col("o_orderpriority").alias("city"),
    )
    joined = attach(lines, known, "l_orderkey", "inner", stored=True)
    lost = F.col("l_quantity") == 50
    return joined.select(
        F.concat_ws(
            "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            F.col("l_quantity").cast("int"), hundredths("l_extendedprice").cast("long"),
        ).alias("order_id"),
        "placed_at",
        "city",
        F.col("l_orderkey").alias("restaurant_id"),
        F.col("l_linenumber").alias("courier_id"),
        F.when(F.col("l_returnflag") == "R", "cancelled").otherwise("delivered").alias("status"),
        text(F.timestamp_add("DAY", F.col("l_linenumber"), F.col("o_orderdate"))).alias("picked_up_at"),
        F.when(~lost, text(F.col("l_shipdate"))).alias("delivered_at"),
        F.col("l_discount").alias("discount"),
    )


RAW_RULES = LabelRules(
    skewed_group="2-HIGH",
    skew_minutes=330,
    max_minutes=3 * 365 * 1440,
    late_minutes=365 * 1440,
    natural_key=("placed_at", "city", "restaurant_id", "courier_id"),
)

RAW_ORDERS = """
raw_orders as (
  select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int),
                   cast(floor(l_extendedprice * 100 + 0.5::double) as bigint)) as order_id,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') as placed_at,
         o_orderpriority as city, l_orderkey as restaurant_id, l_linenumber as courier_id,
         case when l_returnflag = 'R' then 'cancelled' else 'delivered' end as status,
         strftime(o_orderdate + l_linenumber * interval 1 day, '%Y-%m-%dT%H:%M:%S') as picked_up_at,
         case when l_quantity <> 50 then strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') end as delivered_at,
         l_discount as discount
  from lineitem join orders on l_orderkey = o_orderkey
),
timed as (
  select *, date_diff('second', placed_utc, delivered_ts) / 60.0::double as actual_minutes
  from (
    select *, cast(placed_at as timestamp) - case when city = '2-HIGH' then interval 330 minute
                                                  else interval 0 minute end as placed_utc,
           cast(picked_up_at as timestamp) as picked_ts, cast(delivered_at as timestamp) as delivered_ts
    from raw_orders
  )
),
reasoned as (
  select *, case when status <> 'delivered' then 'not_delivered'
                 when delivered_ts is null then 'no_delivery_time'
                 when not delivered_ts > picked_ts then 'delivered_before_pickup'
                 when not actual_minutes > 0 then 'not_positive'
                 when not actual_minutes < 1576800 then 'too_long' end as reason
  from timed
),
ranked as (
  select *, row_number() over (partition by placed_at, city, restaurant_id, courier_id order by order_id) as rn
  from reasoned where reason is null
)"""
