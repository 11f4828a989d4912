import json
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pyspark.ml import Pipeline
from pyspark.ml.feature import SQLTransformer

from punctual.operators.store import build_store
from punctual.operators.store_state import StoreSpec, StoreState, finished, merged, state_of
from punctual.plans.catalogue import streams
from punctual.session import shared_path
from punctual.sources.releases import pinned_stores, publish_model, read_model, release, released
from punctual.sources.versions import expire, latest_version, let_out, live_version, publish, read_version, version_folders, withdraw
from punctual.streaming.common import drain, drained, event_time, file_stream, state_in_rocksdb
from punctual.streaming.orders import OrderLifecycle, bias_by_window, deliveries, drop_twins, order_outcomes, orders_in_flight, windows_so_far
from punctual.streaming.requests import parse_requests, refresh_merged, refresh_store, respond, score_stream, serve_stream

EVENTS = "id int, k string, ts timestamp_ntz, y double, pred double"


def event_rows(spark, rows):
    return spark.createDataFrame(rows, "id int, k string, t string, y double, pred double").select(
        "id", "k", F.col("t").cast("timestamp_ntz").alias("ts"), "y", "pred"
    )


def write_files(spark, batches):
    folder = shared_path(spark, "in")
    for i, rows in enumerate(batches):
        event_rows(spark, rows).coalesce(1).write.parquet(os.path.join(folder, f"part{i}"))
    return folder


def stream(spark, batches):
    folder = write_files(spark, batches)
    return event_time(file_stream(spark, os.path.join(folder, "*"), EVENTS, files_per_batch=1), "ts")


def test_twins_in_a_later_batch_are_dropped(spark):
    first = [(1, "a", "2025-01-01 10:00:00", 1.0, 1.0), (2, "b", "2025-01-01 10:01:00", 1.0, 1.0)]
    later = [(3, "a", "2025-01-01 10:00:30", 1.0, 1.0), (4, "c", "2025-01-01 10:02:00", 1.0, 1.0)]
    out = shared_path(spark, "out")
    drain(drop_twins(stream(spark, [first, later]), ["k"], "ts", "1 hour"), out)
    got = drained(spark, out, "id int, k string, ts timestamp, y double, pred double")
    assert sorted(r["k"] for r in got.collect()) == ["a", "b", "c"] and got.count() == 3


def test_daily_bias_of_closed_days(spark):
    days = [(d, "a", f"2025-01-0{d} 10:00:00", 10.0, 10.0 + d) for d in (1, 2, 3)]
    out = shared_path(spark, "out")
    drain(bias_by_window(stream(spark, [days]), "ts", "pred", "y"), out)
    got = drained(spark, out, "window_start timestamp, rows long, bias double, mae double")
    assert sorted((r["rows"], r["bias"]) for r in got.collect()) == [(1, 1.0), (1, 2.0)]


def test_deliveries_stream_equals_batch(spark):
    rows = [(i, f"k{i % 5}", f"2025-01-01 {8 + i % 12:02d}:{i:02d}:00", 0.0, 0.0) for i in range(50)]
    placed = [r for r in rows if r[0] % 2 == 0]
    delivered = [r for r in rows if r[0] % 2 == 1]

    def sides(p, d):
        return (
            p.select("id", "k", F.col("ts").alias("placed_at")),
            d.select(F.col("id").alias("d_id"), "k", F.col("ts").alias("delivered_at")),
        )

    options = dict(on=["k"], placed_at="placed_at", delivered_at="delivered_at", longest="3 hours")
    out = shared_path(spark, "out")
    drain(deliveries(*sides(stream(spark, [placed]), stream(spark, [delivered])), **options), out)
    schema = "id int, k string, placed_at timestamp, d_id int, delivered_at timestamp, actual_minutes double"
    got = {(r["id"], r["d_id"], r["actual_minutes"]) for r in drained(spark, out, schema).collect()}
    batch = deliveries(
        *sides(event_time(event_rows(spark, placed), "ts"), event_time(event_rows(spark, delivered), "ts")), **options
    )
    want = {(r["id"], r["d_id"], r["actual_minutes"]) for r in batch.collect()}
    assert got == want and len(got) > 0 and all(0 < m < 180 for _, _, m in got)


def body(**fields):
    return (json.dumps(fields),)


REQUESTS = [
    body(order_id="1", restaurant_id="R1", n_items=3, weather="rain", placed_at="2025-11-14T19:30:00+05:30"),
    body(order_id="2", restaurant_id="R9", n_items=1),
    body(order_id="3", restaurant_id="R1", n_items=31),
    body(order_id="4", restaurant_id="R1", n_items=3, weather="hail"),
    body(order_id="5", restaurant_id="R1", n_items=3, placed_at="soon"),
    body(restaurant_id="R1", n_items=3),
    ("not json",),
    body(order_id="6", restaurant_id="R2", n_items=2, placed_at="2025-11-14T19:30:00"),
]


def test_requests_are_validated(spark):
    got = parse_requests(spark.createDataFrame(REQUESTS, "body string")).collect()
    assert [r["problem"] for r in got] == [None, None, "n_items", "weather", "placed_at", "order_id", "order_id", None]
    assert got[0]["placed_utc"].hour == 19 and got[1]["weather"] == "clear" and got[1]["placed_utc"] is not None


def test_request_rules(spark):
    cases = [
        ('{"order_id":"1","restaurant_id":"R","n_items":"2","placed_at":""}', None),
        ('{"order_id":"1","restaurant_id":"R","n_items":2.0,"placed_at":null,"note":{"weather":"hail"}}', None),
        ('{"order_id":"1","restaurant_id":"R","n_items":2.5}', "n_items"),
        ('{"order_id":"1","restaurant_id":"R","n_items":2,"weather":null}', "weather"),
        ('{"order_id":5,"restaurant_id":"R","n_items":2}', "order_id"),
        ('{"order_id":"1","restaurant_id":"R","n_items":2,"placed_at":7}', "placed_at"),
        ('["order_id"]', "order_id"),
        (None, "order_id"),
    ]
    got = parse_requests(spark.createDataFrame([(b,) for b, _ in cases], "body string")).collect()
    assert [r["problem"] for r in got] == [p for _, p in cases]
    assert got[0]["n_items"] == 2 and got[0]["placed_utc"] is not None and got[1]["weather"] == "clear"
    offset = spark.createDataFrame([('{"order_id":"1","restaurant_id":"R","n_items":2,"placed_at":"2025-01-01T12:00:00+05:30"}',)], "body string")
    assert parse_requests(offset).first()["placed_utc"].hour == 12
    assert parse_requests(offset, hour_as_given=False).first()["placed_utc"].hour == 6


def score(rows):
    return rows.withColumn("pred", 10 + 3 * F.col("distance_km") + F.col("n_items"))


STORE = "restaurant_id string, city string, distance_km double, prep_min_estimate double, courier_rating double, " \
    "computed_at string, distance_unit string"


def test_scoring_stream_names_its_store_version(spark):
    root, out, inbox = (shared_path(spark, n) for n in ("store", "out", "inbox"))
    lines = [("R1", "Pune", 2.0, 12.0, 4.0, "2025-01-01T00:00:00Z", "km"), ("R2", "Pune", 4.0, None, 4.0, "2025-01-01T00:00:00Z", "km")]
    publish(spark.createDataFrame(lines, STORE), root)
    spark.createDataFrame(REQUESTS, "body string").write.parquet(inbox)

    def go():
        score_stream(file_stream(spark, inbox, "body string"), root, score, out).awaitTermination()

    go()
    scored = spark.read.parquet(os.path.join(out, "scored"))
    got = {r["order_id"]: r for r in scored.collect()}
    assert sorted(got) == ["1", "2", "6"]
    assert got["1"]["pred"] == 19.0 and got["1"]["hour"] == 19 and not got["1"]["used_default_profile"]
    assert got["2"]["used_default_profile"] and got["2"]["city"] == "Mumbai"
    assert got["6"]["filled"] == 1 and got["6"]["prep_min_estimate"] == 0.0
    assert {r["store_version"] for r in got.values()} == {1}
    assert spark.read.parquet(os.path.join(out, "quarantine")).count() == 5
    assert [r["store_version"] for r in spark.read.parquet(os.path.join(out, "alerts")).collect()] == [1]
    response = respond(scored, ["distance_km", "n_items", "hour", "dow", "city", "weather"], F.lit(5.6), F.col("store_computed_at"))
    first = response.filter("order_id = '1'").first()
    assert first["eta_minutes"] == 19.0 and first["features_used"]["city"] == "Pune"

    # a newer store is picked up by the next batch without a restart of anything else
    publish(spark.createDataFrame(lines[:1], STORE).withColumn("distance_km", F.lit(20.0)), root)
    spark.createDataFrame(REQUESTS[:1], "body string").write.mode("append").parquet(inbox)
    go()
    again = spark.read.parquet(os.path.join(out, "scored")).filter("store_version = 2").first()
    assert again["pred"] == 73.0


def test_scoring_before_anything_is_published(spark):
    root, out, inbox = (shared_path(spark, n) for n in ("store", "out", "inbox"))
    spark.createDataFrame(REQUESTS, "body string").write.parquet(inbox)
    score_stream(file_stream(spark, inbox, "body string"), root, score, out).awaitTermination()
    rows = spark.read.parquet(os.path.join(out, "scored")).collect()
    assert len(rows) == 3 and all(r["used_default_profile"] and r["store_computed_at"] is None for r in rows)
    assert spark.read.parquet(os.path.join(out, "alerts")).count() == 1


def counted(rows):
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))


def test_refresh_equals_a_full_build_and_reads_only_what_it_touches(spark):
    lots = [[(i, f"k{i % 7}", "2025-01-01 10:00:00", 1.0 * i, 1.0) for i in range(40)], [(90, "k3", "2025-01-02 10:00:00", 5.0, 1.0), (91, None, "2025-01-02 10:00:00", 2.0, 1.0)]]
    root, inbox, progress = (shared_path(spark, n) for n in ("store", "in", "progress"))
    seen = []

    def build(rows):
        seen.append(rows.select("k").distinct().count())
        return counted(rows)

    def refresh():
        refresh_store(file_stream(spark, inbox, EVENTS), "k", build, root, progress, trigger={"availableNow": True}).awaitTermination()

    for lot in lots:
        event_rows(spark, lot).coalesce(1).write.mode("append").parquet(inbox)
        refresh()
    assert seen == [7, 2] and latest_version(spark, root) == 2
    want = sorted(map(str, counted(event_rows(spark, [r for lot in lots for r in lot])).collect()))
    assert sorted(map(str, read_version(spark, root).drop("store_version").collect())) == want

    # lost progress: batches begin at 0 again, versions do not
    progress = shared_path(spark, "progress")
    refresh()
    assert latest_version(spark, root) == 3
    assert sorted(map(str, read_version(spark, root).drop("store_version").collect())) == want


def test_versions_are_never_overwritten(spark):
    root = shared_path(spark, "store")
    assert publish(spark.range(3), root, "a:0") == 1
    open_reader = read_version(spark, root)
    assert publish(spark.range(9), root, "a:0") == 1 and latest_version(spark, root) == 1
    assert publish(spark.range(5), root, "b:0") == 2
    assert open_reader.count() == 3 and read_version(spark, root, 1).count() == 3
    for n in range(4):
        publish(spark.range(n), root)
    assert expire(spark, root, keep=2, grace_seconds=3600) == 0 and read_version(spark, root, 1).count() == 3
    assert expire(spark, root, keep=2, grace_seconds=-60) == 4
    assert latest_version(spark, root) == 6 and read_version(spark, root).count() == 3 and read_version(spark, root, 5).count() == 2
    with pytest.raises(FileNotFoundError):
        read_version(spark, root, 1)
    assert publish(spark.range(1), root) == 7


def test_withdrawn_and_held_versions_are_passed_over(spark):
    root = shared_path(spark, "store")
    for n in (3, 9, 5):
        publish(spark.range(n), root)
    assert withdraw(spark, root, 3) == 2 and read_version(spark, root).count() == 9 and latest_version(spark, root) == 3
    assert publish(spark.range(4), root, held=True) == 4 and live_version(spark, root) == 2
    assert withdraw(spark, root, 2) == 1 and read_version(spark, root).count() == 3
    let_out(spark, root, 4)
    assert read_version(spark, root).count() == 4 and publish(spark.range(6), root) == 5
    assert read_version(spark, root, 3).count() == 5  # by its number it can still be looked at
    # the last live one outlives any number of withdrawn ones
    for n in range(3):
        withdraw(spark, root, publish(spark.range(n), root))
    assert expire(spark, root, keep=1, grace_seconds=-60) == 6
    assert live_version(spark, root) == 5 and read_version(spark, root).count() == 6 and latest_version(spark, root) == 8
    withdraw(spark, root, 5)
    assert live_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, root)
    with pytest.raises(FileNotFoundError):
        withdraw(spark, root, 99)


# released pairs of table and model


def model_of(spark, expression):
    statement = f"SELECT *, CAST({expression} AS DOUBLE) AS pred FROM __THIS__"
    return Pipeline(stages=[SQLTransformer(statement=statement)]).fit(spark.range(1))


def test_a_pair_is_released_together_and_swapped_between_batches(spark):
    store, models, pairs, out, inbox = (shared_path(spark, n) for n in ("store", "models", "pairs", "out", "inbox"))
    lines = [("R1", "Pune", 2.0, 12.0, 4.0, "2025-01-01T00:00:00Z", "km"), ("R2", "Pune", 4.0, None, 4.0, "2025-01-01T00:00:00Z", "km")]

    def answer(bodies):
        spark.createDataFrame(bodies, "body string").coalesce(1).write.mode("append").parquet(inbox)
        serve_stream(file_stream(spark, inbox, "body string"), pairs, out).awaitTermination()

    def rows(name):
        return spark.read.parquet(os.path.join(out, name)).collect()

    # nothing released: all are refused, none is lost
    answer(REQUESTS[:4])
    assert sorted(r["problem"] for r in rows("quarantine")) == ["n_items", "no_model", "no_model", "weather"]
    assert [(r["batch_id"], r["store_version"]) for r in rows("alerts")] == [(0, None)]

    publish(spark.createDataFrame(lines, STORE), store)
    metrics = spark.createDataFrame([(5.6, 100)], "model_mae double, n_test int")
    assert publish_model(model_of(spark, "10 + 3 * distance_km + n_items"), models, ["distance_km", "n_items"], metrics) == 1
    assert json.loads(read_model(spark, models)[1]["metrics"]) == {"model_mae": 5.6, "n_test": 100}
    assert release(spark, pairs, store, models) == 1
    # published, but not yet released: the next batch must not see either
    publish(spark.createDataFrame(lines[:1], STORE).withColumn("distance_km", F.lit(20.0)), store)
    publish_model(model_of(spark, "city = 'Pune'"), models, ["city"])
    answer(REQUESTS)
    first = {r["order_id"]: r for r in rows("responses")}
    assert {k: r["eta_minutes"] for k, r in first.items()} == {"1": 19.0, "2": 21.5, "6": 24.0}
    assert {(r["store_version"], r["model_version"], r["release"]) for r in first.values()} == {(1, 1, 1)}
    assert json.loads(first["1"]["features_used"]) == {"distance_km": 2.0, "n_items": 3}
    assert first["2"]["used_default_profile"] and first["1"]["store_computed_at"] == "2025-01-01T00:00:00Z"

    assert release(spark, pairs, store, models, store_version=1) == 2
    answer(REQUESTS[:1])
    assert release(spark, pairs, store, models) == 3
    answer(REQUESTS[:1])
    later = sorted((r["release"], r["store_version"], r["model_version"], r["eta_minutes"]) for r in rows("responses") if r["release"] > 1)
    assert later == [(2, 1, 2, 1.0), (3, 2, 2, 1.0)]
    # the last two releases hold both tables, whatever is expired
    assert pinned_stores(spark, pairs, store, keep=2) == {1, 2}
    for _ in range(3):
        publish(spark.createDataFrame(lines, STORE), store)
    expire(spark, store, keep=1, grace_seconds=-60, pinned=pinned_stores(spark, pairs, store, keep=1))
    assert released(spark, pairs).store.count() == 1 and latest_version(spark, store) == 5
    with pytest.raises(FileNotFoundError):
        read_version(spark, store, 1)


# the feature table as mergeable state

SPEC = StoreSpec("k", mode="m", medians={"y": ("y", 2), "z": ("z", None)}, means={"avg_y": ("y", 3)})
SHOP = "id int, k string, m string, y double, z double"


def shop_rows(start, n):
    out = []
    for i in range(start, start + n):
        k = None if i % 11 == 0 else f"k{i % 5}"
        m = None if i % 3 == 0 or k == "k4" else f"m{i % 4}"
        y = None if k == "k3" else float(i * 7919 % 101)
        out.append((i, k, m, y, None if i % 2 else float(i % 6)))
    return out


def full_build(spark, rows):
    df = spark.createDataFrame(rows, SHOP)
    return build_store(df, "k", mode="m", medians=SPEC.medians, means=SPEC.means, computed_at=F.lit("2025-01-01 00:00:00").cast("timestamp"))


def lines(df):
    return sorted(str(r.asDict()) for r in df.select(*sorted(df.columns)).collect())


def test_state_of_two_lots_is_the_state_of_all_rows(spark):
    one, two = shop_rows(0, 70), shop_rows(70, 40)
    parts = [state_of(spark.createDataFrame(r, SHOP), SPEC) for r in (one, two)]
    both = merged(StoreState(*[getattr(parts[0], f).unionByName(getattr(parts[1], f)) for f in ("counts", "values")]), SPEC)
    stamp = F.lit("2025-01-01 00:00:00").cast("timestamp")
    assert lines(finished(both, SPEC, stamp)) == lines(full_build(spark, one + two))
    none = state_of(spark.createDataFrame([], SHOP), SPEC)
    assert finished(merged(none, SPEC), SPEC, stamp).count() == 0


@pytest.mark.parametrize("parts", [2, 16])
def test_merged_refresh_reads_a_row_once_and_equals_a_full_build(spark, parts):
    root, inbox, progress, pairs = (shared_path(spark, n) for n in ("store", "in", "progress", "pairs"))
    stamp = F.lit("2025-01-01 00:00:00")
    every = []
    for n, (start, size) in enumerate([(0, 60), (60, 1), (61, 30), (91, 0), (91, 9)]):
        lot = shop_rows(start, size)
        every += lot
        path = os.path.join(inbox, f"lot{n}")
        spark.createDataFrame(lot, SHOP).coalesce(1).write.parquet(path)
        arrivals = file_stream(spark, os.path.join(inbox, "*"), SHOP)
        refresh_merged(
            arrivals, SPEC, root, progress, computed_at=stamp, parts=parts, keep=2, grace_seconds=-60, release_root=pairs,
            trigger={"availableNow": True},
        ).awaitTermination()
        assert lines(read_version(spark, root).drop("store_version")) == lines(full_build(spark, every))
        # what has been merged is never needed again
        spark.createDataFrame([], SHOP).coalesce(1).write.mode("overwrite").parquet(path)
    # old versions, and the parts that only they name, are gone
    assert len(version_folders(spark, root)) <= 3
    named = spark.read.parquet(*version_folders(spark, os.path.join(progress, "state"))).collect()
    assert set(os.listdir(os.path.join(progress, "parts"))) == {r[c] for r in named for c in ("counts", "values")}


# windows


def test_windows_so_far_has_open_windows_and_a_ledger_of_late_rows(spark):
    first = [(1, "a", "2025-01-02 10:00:00", 10.0, 11.0), (2, "a", "2025-01-04 10:00:00", 10.0, 12.0)]
    late = [(3, "a", "2025-01-01 10:00:00", 10.0, 10.0), (4, "a", "2025-01-02 11:00:00", 10.0, 19.0), (5, "a", "2025-01-04 11:00:00", 10.0, 14.0)]
    out, folder = shared_path(spark, "out"), shared_path(spark, "in")
    for lot in (first, late):
        event_rows(spark, lot).coalesce(1).write.mode("append").parquet(folder)
        drain(bias_by_window(event_time(file_stream(spark, folder, EVENTS), "ts"), "ts", "pred", "y"), out)
    emitted = drained(spark, out, "window_start timestamp, rows long, bias double, mae double")
    arrived = event_time(event_rows(spark, first + late), "ts")
    got = {r["window_start"].day: tuple(r)[1:] for r in windows_so_far(emitted, arrived, "ts", "pred", "y").collect()}
    assert got == {1: (0, None, None, True, 1), 2: (1, 1.0, 1.0, True, 1), 4: (2, 3.0, 3.0, False, 0)}
    nothing = emitted.limit(0)
    got = windows_so_far(nothing, arrived, "ts", "pred", "y").collect()
    assert sorted((r["window_start"].day, r["rows"], r["closed"]) for r in got) == [(1, 1, False), (2, 2, False), (4, 2, False)]


# outcomes of orders

STEPS = "order_id string, kind string, at timestamp"


def test_outcomes_with_timers_survive_a_restart_and_any_order_of_arrival(spark):
    folder, out = shared_path(spark, "steps"), shared_path(spark, "out")

    def run(rows):
        df = spark.createDataFrame(rows, "order_id string, kind string, t string")
        df = df.select("order_id", "kind", F.col("t").cast("timestamp").alias("at"))
        df.coalesce(1).write.mode("append").parquet(folder)
        with state_in_rocksdb(spark):
            drain(order_outcomes(file_stream(spark, folder, STEPS), ["order_id"]), out)
        got = drained(spark, out, "order_id string, outcome string, placed_at timestamp, actual_minutes double").collect()
        assert len({r["order_id"] for r in got}) == len(got)
        return {r["order_id"]: (r["outcome"], r["actual_minutes"]) for r in got}

    day = "2025-01-01 "
    done = run([
        ("a", "placed", day + "10:00:00"), ("a", "delivered", day + "10:40:30"),
        ("b", "delivered", day + "10:30:00"), ("c", "placed", day + "10:00:00"), ("c", "cancelled", day + "10:05:00"),
        ("d", "placed", day + "10:00:00"), ("e", "placed", day + "10:30:00"), ("e", "delivered", day + "10:29:00"),
        ("f", "placed", day + "10:00:00"), ("f", "delivered", day + "22:00:00"), ("g", "cancelled", day + "10:20:00"),
        ("h", "placed", day + "10:00:00"), ("h", "cancelled", day + "10:30:00"), ("h", "delivered", day + "10:20:00"),
        ("a", "delivered", day + "10:50:00"), ("i", "delivered", day + "11:00:00"), (None, "placed", day + "10:00:00"),
    ])
    known = {"a": ("delivered", 40.5), "c": ("cancelled", None), "e": ("not_positive", -1.0), "f": ("timed_out", None), "h": ("delivered", 20.0)}
    # the latest step seen is at 22:00, less an hour of delay: no timer has run out
    assert done == known
    open_ = {r["order_id"]: r["placed_at"] for r in orders_in_flight(spark, os.path.join(out, "progress")).collect()}
    assert sorted(open_, key=str) == sorted(["b", "d", "g", "i", None], key=str) and open_["b"] is None

    # after a restart: a placement behind the watermark is dropped, one in time completes nothing yet, repeats change nothing
    done = run([("b", "placed", day + "10:00:00"), ("j", "placed", day + "21:30:00"), ("a", "cancelled", day + "21:10:00")])
    assert done == known
    done = run([("z", "placed", "2025-01-03 10:00:00")])
    known |= {"d": ("timed_out", None), None: ("timed_out", None), "b": ("never_placed", None), "g": ("never_placed", None),
              "i": ("never_placed", None), "j": ("timed_out", None)}
    assert done == known
    assert [r["order_id"] for r in orders_in_flight(spark, os.path.join(out, "progress")).collect()] == ["z"]


@pytest.mark.parametrize("buckets", [1, 16])
def test_outcomes_of_orders_that_share_a_state(spark, buckets):
    """Keys of several types, null among them, are told apart in one bucket and known again in a later batch."""
    folder, out = shared_path(spark, "steps"), shared_path(spark, "out")
    on = ["day", "no", "tag"]

    def run(rows):
        df = spark.createDataFrame(rows, "i int, kind string, t string")
        i = F.col("i")
        df = df.select(
            F.when(i != 2, F.timestamp_micros(i.cast("long") * 1_000_001)).alias("day"), F.when(i != 3, i + F.lit(2**60)).alias("no"),
            F.encode(F.concat(F.lit("x"), i), "utf-8").alias("tag"), "kind", F.col("t").cast("timestamp").alias("at"),
        )
        df.coalesce(1).write.mode("append").parquet(folder)
        arriving = file_stream(spark, folder, "day timestamp, no long, tag binary, kind string, at timestamp")
        with state_in_rocksdb(spark):
            drain(order_outcomes(arriving, on, buckets=buckets), out)
        got = drained(spark, out, "day timestamp, no long, tag binary, outcome string, placed_at timestamp, actual_minutes double").collect()
        assert all((r["day"] is None) == (r["tag"] == b"x2") and (r["no"] is None) == (r["tag"] == b"x3") for r in got)
        return sorted((bytes(r["tag"]).decode(), r["outcome"], r["actual_minutes"]) for r in got)

    day = "2025-01-01 "
    # the watermark is 22:00, when the first, but not the second, runs out
    done = run([
        (1, "placed", day + "10:00:00"), (2, "placed", day + "10:00:00.001"), (3, "placed", day + "22:00:00"),
        (4, "cancelled", day + "22:30:00"), (5, "unheard of", day + "22:40:00"), (6, "placed", day + "22:50:00"), (6, "delivered", day + "23:00:00"),
    ])
    first = [("x1", "timed_out", None), ("x6", "delivered", 10.0)]
    assert [r for r in done if r[0] != "x2"] == first
    done = run([(3, "delivered", day + "22:30:00"), (4, "placed", day + "22:20:00"), (6, "placed", day + "22:45:00"), (7, "placed", day + "22:50:00")])
    first += [("x3", "delivered", 30.0), ("x4", "cancelled", None)]
    assert [r for r in done if r[0] != "x2"] == sorted(first)
    left = orders_in_flight(spark, os.path.join(out, "progress"))
    assert {r["tag"] for r in left.collect()} - {b"x2"} == {b"x7"} and left.schema["no"].dataType.simpleString() == "bigint"
    done = run([(8, "placed", "2025-01-03 10:00:00")])
    assert done == sorted([*first, ("x2", "timed_out", None), ("x7", "timed_out", None)])
    assert [r["tag"] for r in orders_in_flight(spark, os.path.join(out, "progress")).collect()] == [b"x8"]


def test_a_bucket_of_orders_takes_few_calls_of_its_state():
    """Each call is a message to the JVM: their number is that of the buckets and not that of the orders."""
    calls = []

    class Told:
        def __init__(self):
            self.value = None

        def get(self):
            calls.append("get")
            return self.value

        def update(self, value):
            calls.append("update")
            self.value = value

        def clear(self):
            calls.append("clear")
            self.value = None

        def exists(self):
            calls.append("exists")
            return self.value is not None

    class Handle:
        def __init__(self):
            self.timers = set()

        def getValueState(self, name, schema):
            return Told()

        def listTimers(self):
            calls.append("list")
            return list(self.timers)

        def registerTimer(self, at):
            calls.append("register")
            self.timers.add(at)

        def deleteTimer(self, at):
            calls.append("delete")
            self.timers.remove(at)

    handle = Handle()
    orders = OrderLifecycle(T.StructType().add("order_id", "long"), 720)
    orders.init(handle)
    steps = [Row(_bucket=0, at=None, order_id=i, kind="placed", at_ms=60_000 * i) for i in range(1000)]
    assert list(orders.handleInputRows((0,), iter(steps), None)) == [] and len(calls) <= 5 and handle.timers == {720 * 60_000}
    calls.clear()
    steps = [Row(_bucket=0, at=None, order_id=i, kind="delivered", at_ms=60_000 * (i + 5)) for i in range(1000)]
    assert [r["actual_minutes"] for r in orders.handleInputRows((0,), iter(steps), None)] == [5.0] * 1000 and len(calls) <= 5


def test_a_lot_of_one_task_is_read_by_several(spark, tmp_path, monkeypatch):
    inbox = str(tmp_path / "inbox")
    monkeypatch.setattr(streams, "FILE_ROWS", 100)
    streams.arrive(spark.range(1000, numPartitions=1), inbox)
    streams.arrive(spark.range(1000, 1050, numPartitions=1), inbox)
    rows = spark.read.parquet(inbox)
    assert sorted(r["id"] for r in rows.collect()) == list(range(1050))
    sizes = rows.groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in sizes) == [50] + [100] * 10
