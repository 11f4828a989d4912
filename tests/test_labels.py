from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from punctual.functions.clean import parse_local, parse_utc
from punctual.operators.dedup import duplicate_counts, keep_first, rows_seen_in, split_overlap
from punctual.operators.labels import (
    LabelRules,
    assert_labels,
    drop_ledger,
    label,
    label_checks,
    labelling_diff,
    naive_minutes_by_group,
)
from punctual.session import shared_path
from punctual.sources.schemas import RAW_ORDERS


def order(order_id, placed, picked, delivered, *, city="Mumbai", status="delivered", restaurant="R1", km=2.0):
    return {
        "order_id": order_id, "placed_at": placed, "city": city, "restaurant_id": restaurant, "courier_id": "C1",
        "status": status, "distance_km": km, "subtotal_inr": 300.0, "picked_up_at": picked, "delivered_at": delivered,
        "n_items": 2, "weather": "clear", "is_weekend": False, "courier_rating": 4.5,
        "restaurant_prep_min_estimate": 12.0, "promised_eta_min": 30.0,
    }


LOG = [
    order("ORD-1", "2025-03-02T12:00:00", "2025-03-02T12:20:00", "2025-03-02T12:35:30"),
    order("ORD-2", "2025-03-02T17:30:00", "2025-03-02T12:20:00", "2025-03-02T12:40:00", city="Pune"),
    order("ORD-3", "2025-03-02T13:00:00", "2025-03-02T13:20:00", None, restaurant="R3"),
    order("ORD-4", "2025-03-02T13:00:00", "2025-03-02T13:30:00", "2025-03-02T13:20:00", restaurant="R4"),
    order("ORD-5", "2025-03-02T13:00:00", None, None, status="cancelled", restaurant="R5"),
    order("ORD-6", "2025-03-02T13:00:00", None, None, status="in_flight", restaurant="R6"),
    order("ORD-7", "2025-03-02T01:00:00", "2025-03-02T01:20:00", "2025-03-02T14:00:00", restaurant="R7"),
    order("ORD-8", "2025-03-02T12:00:00", "2025-03-02T12:20:00", "2025-03-02T12:35:30"),
    order("ORD-9", "2025-03-02T22:00:00", "2025-03-02T22:20:00", "2025-03-02T23:45:00", restaurant="R9"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(LOG, RAW_ORDERS)


def test_each_rule(raw):
    out = {r["order_id"]: r for r in label(raw).collect()}
    assert sorted(out) == ["ORD-1", "ORD-2", "ORD-9"]
    assert out["ORD-1"]["actual_minutes"] == 35.5
    assert out["ORD-2"]["placed_utc"] == datetime(2025, 3, 2, 12, 0)
    assert out["ORD-2"]["actual_minutes"] == 40.0
    assert (out["ORD-2"]["hour"], out["ORD-2"]["dow"], out["ORD-2"]["doy"]) == (12, 7, 61)
    assert not out["ORD-1"]["severely_late"] and out["ORD-9"]["severely_late"]


def test_twins_can_be_kept(raw):
    assert label(raw, drop_duplicates=False).count() == 4


def test_ledger(raw):
    lines = {r["outcome"]: (r["rows"], r["share"]) for r in drop_ledger(raw).collect()}
    assert lines["kept"] == (3, 3 / 9)
    assert lines["not_delivered"][0] == 2
    for reason in ("duplicate", "no_delivery_time", "delivered_before_pickup", "too_long"):
        assert lines[reason][0] == 1
    assert sum(rows for rows, _ in lines.values()) == len(LOG)


def test_naive_minutes_show_the_clock(raw):
    lines = {r["city"]: r for r in naive_minutes_by_group(raw).collect()}
    assert lines["Pune"]["median_minutes"] == -290.0 and lines["Pune"]["share_negative"] == 1.0
    assert lines["Mumbai"]["share_negative"] == 0.0


def test_label_checks(raw):
    checks = label_checks(label(raw), raw)
    assert_labels(checks, kept=(0.3, 0.4))
    with pytest.raises(AssertionError):
        assert_labels(checks)


def test_labelling_diff(raw):
    careful, careless = label(raw), label(raw, LabelRules(skewed_group=None))
    lines = {r["outcome"]: r["orders"] for r in labelling_diff(careful, careless, "order_id").collect()}
    assert lines == {"same": 2, "only_a": 1}


def test_keep_first_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    single = keep_first(df, ["k"], ["id"])
    assert plan_of(single).count("WindowGroupLimit") == 2
    assert sorted(r["id"] for r in single.collect()) == list(range(7))
    counts = duplicate_counts(df, ["k"]).first()
    assert (counts["rows"], counts["keys"], counts["surplus"]) == (1000, 7, 993)


def test_overlap(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "id int, k string")
    line = split_overlap(df, ["k"], F.col("id") <= 1).first()
    assert tuple(line) == (1, 1, 3)
    seen = rows_seen_in(df.filter("id > 1"), df.filter("id <= 1"), ["k"])
    assert [r["id"] for r in seen.collect()] == [2]


def test_status_filter_reaches_the_scan(spark, raw):
    path = shared_path(spark, "orders")
    raw.write.parquet(path)
    labelled = label(spark.read.parquet(path))
    plan = plan_of(labelled)
    assert "EqualTo(status,delivered)" in plan and "IsNotNull(delivered_at)" in plan
    assert labelled.count() == 3


def test_instants_in_the_repeated_hour_of_summer_time(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        texts = ["2025-11-02T05:30:00Z", "2025-11-02T06:30:00Z", "2025-11-02T12:00:00+05:30"]
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = [r[0] for r in df.select(F.date_format(parse_utc("t"), "HH:mm")).collect()]
        assert got == ["05:30", "06:30", "06:30"]
        kept = [r[0] for r in df.select(F.date_format(parse_local("t"), "HH:mm")).collect()]
        assert kept == ["05:30", "06:30", "12:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
