import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of
from punctual.functions.clean import fill_zero, nan_to_null, parse_utc, to_number
from punctual.functions.features import ratio, trip_rules
from punctual.functions.scores import idle_minutes, promises_broken, r2
from punctual.operators.agreement import kappa, pair_sheets
from punctual.operators.audit import ORDER_TIME, added_columns, assert_no_leakage, audit, column_catalogue, fitted_on_train_only
from punctual.operators.behaviour import implausible, never_lower, prediction_ratio, score_twice, unchanged
from punctual.operators.evaluation import alpha_report, confusion_report, quantile_promises
from punctual.operators.fingerprint import changed_ranges, changed_rows, data_fingerprint, hash_tree
from punctual.operators.groupmap import map_groups
from punctual.operators.history import ORDER_RATIOS, build_features, fit_history
from punctual.operators.lineage import assert_no_leaking_source, column_sources, leaking_sources, lineage_kept
from punctual.operators.lookup import attach, hot_hashes, lookup_with_default, salted_join, unseen
from punctual.operators.profile import positive_rate
from punctual.operators.quantiles import column_medians, counted_quantiles, group_quantiles
from punctual.operators.ranges import training_ranges, with_outside
from punctual.operators.sampling import (
    class_weights,
    convenience,
    oversample,
    shuffled_split,
    simple_random,
    stratified,
    stratum_shares,
    undersample,
)
from punctual.operators.slices import over_budget, shift_period, slice_report, worst_slice
from punctual.session import settle, shared_path
from punctual.operators.split import hash_side, time_split
from punctual.operators.store import StaleStore, check_freshness, order_store, store_alarms, store_drift, store_info
from punctual.operators.thresholds import average_precision, bounded_sweep, merged_cells, recall_at_precision, score_cells, sweep

few = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# --- values -------------------------------------------------------------------------------


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert nan_to_null(df).agg(F.avg("x")).first()[0] == 1.0


def test_parse_utc_honours_offsets(spark):
    df = spark.createDataFrame([("2025-11-14T19:30:00+05:30",), ("2025-11-14T19:30:00",), ("soon",)], "t string")
    out = [r[0] for r in df.select(parse_utc("t").cast("string")).collect()]
    assert out == ["2025-11-14 14:00:00", "2025-11-14 19:30:00", None]


def test_coercion_and_fill(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "t string").withColumn("n", to_number("t"))
    out = fill_zero(df, ["n"]).collect()
    assert [(r["n"], r["filled"]) for r in out] == [(1.5, 0), (0.0, 1), (0.0, 1)]


def test_ratio_by_zero_is_null(spark):
    assert spark.createDataFrame([(4, 0)], "a int, b int").select(ratio("a", "b")).first()[0] is None


def test_rules_are_finite_for_any_row(spark):
    df = spark.createDataFrame(
        [(2.0, 10.0, 3, "rain", 12), (None, None, None, None, None)],
        "distance_km double, restaurant_prep_min_estimate double, n_items int, weather string, hour int",
    )
    got = [r[0] for r in df.select(trip_rules()).collect()]
    assert all(math.isfinite(x) for x in got) and got[0] > got[1]


# --- counters -----------------------------------------------------------------------------


def counters(spark, pred):
    df = spark.createDataFrame([(float(p), 35.0) for p in pred], "p double, y double")
    return df.agg(promises_broken("p", "y"), idle_minutes("p", "y")).first()


def test_counters(spark):
    broken, idle = counters(spark, [30, 40, 50])
    assert broken == pytest.approx(1 / 3) and idle == 20.0
    short, long = counters(spark, [30] * 3), counters(spark, [60] * 3)
    assert long[0] < short[0] and long[1] > short[1]


def test_r2_is_not_a_correlation(spark):
    df = spark.createDataFrame([(10.0, 1.0), (20.0, 2.0), (30.0, 3.0)], "p double, y double")
    assert df.agg(r2("p", "y")).first()[0] < 0


# --- threshold sweep ----------------------------------------------------------------------


def scored(spark, y, p):
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, p)], "y int, p double")


def test_perfect_scorer(spark):
    df = scored(spark, [0] * 90 + [1] * 10, [0.01] * 90 + [0.99] * 10)
    swept = sweep(df, "p", F.col("y") == 1)
    assert recall_at_precision(swept, 0.10).first()[0] == 1.0
    assert average_precision(swept).first()[0] == 1.0


def test_bounds_and_useless_scorer(spark):
    df = scored(spark, [0] * 90 + [1] * 10, [*np.linspace(0, 0.5, 90), *np.linspace(0.5, 1, 10)])
    recall, threshold = recall_at_precision(sweep(df, "p", F.col("y") == 1)).first()
    assert 0 <= recall <= 1 and 0 <= threshold <= 1
    rng = np.random.default_rng(0)
    df = scored(spark, rng.random(2000) < 0.01, rng.random(2000))
    assert recall_at_precision(sweep(df, "p", F.col("y") == 1)).first()[0] < 0.5


def test_no_threshold_is_precise_enough(spark):
    line = recall_at_precision(sweep(scored(spark, [0, 0], [0.1, 0.2]), "p", F.col("y") == 1)).first()
    assert tuple(line) == (0.0, None)


@few
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30)), min_size=1, max_size=60))
def test_sweep_in_ranges_equals_brute_force(spark, points):
    df = scored(spark, [a for a, _ in points], [b for _, b in points])
    got = {r["threshold"]: (r["caught"], r["flagged"]) for r in sweep(df, "p", F.col("y") == 1, lines_per_range=4).collect()}
    want = {
        float(t): (sum(a for a, b in points if b >= t), sum(b >= t for _, b in points)) for t in {b for _, b in points}
    }
    assert got == want


# --- agreement ----------------------------------------------------------------------------


def test_kappa(spark):
    a = spark.createDataFrame([(i, x) for i, x in enumerate([1, 1, 0, 0, 1])], "id int, v int")
    b = spark.createDataFrame([(i, x) for i, x in enumerate([1, 0, 0, 0, 1])] + [(9, 1)], "id int, v int")
    line = kappa(pair_sheets(a, b, "id", "v")).first()
    assert (line["rows"], line["agreed"], line["unpaired"]) == (5, 4, 1)
    assert line["kappa"] == pytest.approx((0.8 - 0.48) / (1 - 0.48))


def test_kappa_is_null_when_chance_always_agrees(spark):
    a = spark.createDataFrame([(1, 1), (2, 1)], "id int, v int")
    assert kappa(pair_sheets(a, a, "id", "v")).first()["kappa"] is None


# --- quantiles ----------------------------------------------------------------------------


@pytest.mark.parametrize("direct", [0, 10**6])
def test_quantiles_are_exact(spark, direct):
    df = spark.range(0, 20000, 1, 5).select(
        (F.col("id") % 3).alias("g"), (F.pmod(F.xxhash64("id"), F.lit(5000)) / 7).alias("v")
    )
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    got = group_quantiles(df, ["g"], "v", wanted, accuracy=200, direct_rows=direct).toPandas().sort_values("g")
    want = df.toPandas().groupby("g").v.quantile(list(wanted.values())).unstack().to_numpy()
    assert np.allclose(got[list(wanted)].to_numpy(), want, rtol=1e-12)


@pytest.mark.parametrize("direct", [0, 1000])
def test_counted_quantiles_equal_those_of_the_rows(spark, direct):
    random = np.random.default_rng(5)
    values = np.concatenate([random.normal(size=3000), random.normal(size=500) * 1e9, np.full(800, 0.5), [-1e308, 1e308, 0.0]])
    rows = [(None if i % 7 == 0 else i % 3, float(v), int(random.integers(1, 4))) for i, v in enumerate(values)]
    rows += [(9, 4.0, 1), (9, None, 3), (9, 5.0, 0), (8, 1.0, 2), (8, 2.0, 2)]
    df = spark.createDataFrame(rows, "g int, v double, n int")
    wanted = {"lo": 0.0, "a": 0.25, "mid": 0.5, "b": 0.975, "hi": 1.0}
    got = {r["g"]: r for r in counted_quantiles(df, ["g"], "v", "n", wanted, direct_rows=direct, cells=50).collect()}
    assert set(got) == {None, 0, 1, 2, 8, 9}
    for g, r in got.items():
        each = np.repeat(*zip(*[(v, n) for k, v, n in rows if k == g and v is not None and n]))
        assert [r[c] for c in wanted] == pytest.approx(list(np.quantile(each, list(wanted.values()))), rel=1e-12)
    assert counted_quantiles(df.limit(0), ["g"], "v", "n", wanted, direct_rows=direct).count() == 0


def test_quantile_of_one_value_and_of_equal_values(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("b", 1.0), ("c", None)], "g string, v double")
    got = {r["g"]: r["m"] for r in group_quantiles(df, ["g"], "v", {"m": 0.5}, direct_rows=0).collect()}
    assert got == {"a": 3.0, "b": 1.0}


def test_column_medians(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 2, 30.0)], "g string, x int, y double")
    assert tuple(column_medians(df, ["g"], {"mx": "x", "my": "y"}).first()) == ("a", 1.5, 20.0)


# --- samples and splits -------------------------------------------------------------------


@pytest.fixture(scope="module")
def pool(spark):
    """Night rows only after the first third; a third of the rows in one city and hour."""
    return spark.range(6000).select(
        F.col("id"),
        F.timestamp_add("MINUTE", F.col("id"), F.lit("2025-01-01").cast("timestamp_ntz")).alias("ts"),
        F.when(F.col("id") % 3 == 0, "X").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("city"),
        F.when(F.col("id") % 3 == 0, 12)
        .when(F.col("id") < 2000, F.lit(10) + F.col("id") % 8)
        .otherwise(F.col("id") % 24)
        .cast("int")
        .alias("hour"),
    )


N = 500
NIGHT = "hour >= 21 or hour < 9"


@pytest.mark.parametrize("cell", [10, 500_000])
def test_samplers(pool, cell):
    head = convenience(pool, N, "ts", "id", rows_per_cell=cell)
    assert sorted(r["id"] for r in head.collect()) == list(range(N))
    assert head.filter(NIGHT).count() == 0
    random = simple_random(pool, N, "id", rows_per_cell=cell)
    assert random.count() == N and random.filter(NIGHT).count() > 0
    strata = stratified(pool, N, "id", ["city", "hour"], rows_per_cell=cell)
    assert abs(strata.count() - N) <= N * 0.20 and strata.filter(NIGHT).count() > 0
    for line in stratum_shares(pool, strata, "city").collect():
        assert abs(line["population_share"] - line["sample_share"]) < 0.06


def test_crowded_instant(spark):
    df = spark.range(3000).select("id", F.lit("2025-01-01").cast("timestamp_ntz").alias("ts"))
    one = convenience(df, 700, "ts", "id", rows_per_cell=5)
    assert one.count() == 700
    assert {r["id"] for r in one.collect()} == {r["id"] for r in convenience(df, 700, "ts", "id").collect()}


@few
@given(st.integers(0, 130), st.sampled_from([1, 7, 1000]))
def test_random_sample_has_exactly_n_rows_and_ignores_layout(spark, n, cell):
    df = spark.range(100)
    a = {r["id"] for r in simple_random(df, n, "id", rows_per_cell=cell).collect()}
    b = {r["id"] for r in simple_random(df.repartition(3), n, "id").collect()}
    assert len(a) == min(n, 100) and a == b


def test_seed_matters(pool):
    a, b = (simple_random(pool, N, "id", seed=s) for s in (1, 2))
    assert a.join(b, "id").count() < N / 2


def test_shuffled_split(pool):
    assert shuffled_split(pool, "id").filter("in_train").count() == 4800


def test_hash_side(pool):
    share = hash_side(pool, "id").agg(F.avg((F.col("side") == "train").cast("int"))).first()[0]
    assert abs(share - 0.8) < 0.03


def test_time_split(pool):
    train, test = time_split(pool, "ts", 1)
    assert train.count() + test.count() == 6000
    assert train.agg(F.max("ts")).first()[0] < test.agg(F.min("ts")).first()[0]
    assert test.count() == 1441


def test_class_resampling(spark):
    df = spark.range(100).withColumn("y", (F.col("id") < 10).cast("int"))
    assert {r["y"]: r["count"] for r in undersample(df, "id", "y", per_rare=2).groupBy("y").count().collect()} == {0: 20, 1: 10}
    assert {r["y"]: r["count"] for r in oversample(df, "y").groupBy("y").count().collect()} == {0: 90, 1: 90}
    assert {r["y"]: r["weight"] for r in class_weights(df, "y").collect()} == {0: 100 / 180, 1: 5.0}
    assert tuple(positive_rate(df, F.col("y") == 1).first()) == (0.1, 10)


# --- lookups ------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    """A third of the rows are copies of one row with one key."""
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100 + 10).alias("k"),
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("x"),
    )
    dim = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert len(hot_hashes(facts, ["k"], 50)) >= 1
    salted = salted_join(facts, dim, ["k"], how, share=50, salts=8)
    plain = facts.join(dim, "k", how)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_large_table_is_not_broadcast(spark):
    facts, dim = spark.range(100).withColumn("x", F.lit(1)), spark.range(50).withColumn("v", F.lit("a"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        small = plan_of(attach(facts, dim, "id"))
        large = plan_of(attach(facts, dim, "id", broadcast_bytes=100))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_lookup_with_default(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    profiles = spark.createDataFrame([(1, "x", 1.0), (2, None, 2.0)], "k int, a string, b double")
    out = {r["k"]: tuple(r)[1:] for r in lookup_with_default(facts, profiles, "k", {"a": "def", "b": 9.0}).collect()}
    assert out == {1: ("x", 1.0, False), 2: (None, 2.0, False), 3: ("def", 9.0, True)}
    assert [r["k"] for r in unseen(facts, profiles, "k").collect()] == [3]


# --- histories and leakage ----------------------------------------------------------------

TRIPS = "order_id string, restaurant_id string, courier_id string, hour int, dow int, actual_minutes double, " \
    "distance_km double, restaurant_prep_min_estimate double, subtotal_inr double, n_items int"


@pytest.fixture(scope="module")
def trips(spark):
    def trip(i):
        return (f"O{i}", f"R{i % 4}", f"C{i % 3}", i % 24, 1 + i % 7, 20.0 + i, 1.0 + i, 10.0, 100.0, i % 5)

    return (
        spark.createDataFrame([trip(i) for i in range(40)], TRIPS),
        spark.createDataFrame([trip(i) for i in range(40, 52)] + [("O99", "R99", "C99", 1, 1, 5.0, 1.0, 1.0, 1.0, 1)], TRIPS),
    )


def test_history_is_fitted_on_train(trips):
    train, test = trips
    built_a = build_features(train, test, ratios=ORDER_RATIOS)
    built_b = build_features(train, test.limit(1), ratios=ORDER_RATIOS)
    added = added_columns(train, built_a[0])
    assert set(built_a[0].columns) == set(built_a[1].columns)
    assert built_a[0].count() == train.count() and built_a[1].count() == test.count()
    assert {"is_night", "is_peak", "is_weekend", "rest_hist_mean", "courier_hist_mean", "km_per_prep_min"} <= set(added)
    assert fitted_on_train_only(built_a[0], built_b[0], ["order_id", *added]).first()["independent"]
    cheat = train.withColumn("rest_hist_mean", F.lit(1.0))
    assert not fitted_on_train_only(built_a[0], cheat, ["order_id", "rest_hist_mean"]).first()["independent"]


def test_unseen_entity_gets_the_train_mean(trips):
    train, test = trips
    history = fit_history(train, ["restaurant_id"], "actual_minutes", "h")
    got = history.apply(test).filter("restaurant_id = 'R99'").first()["h"]
    assert got == train.agg(F.avg("actual_minutes")).first()[0]


HONEST = ["distance_km", "n_items", "city", "weather", "hour", "dow", "courier_rating"]


def test_audit_passes_honest_features():
    assert audit(HONEST) == [] and audit(ORDER_TIME) == []
    assert_no_leakage(HONEST)


@pytest.mark.parametrize(
    "column",
    ["eta_error_min", "courier_payout_inr", "actual_prep_min", "courier_wait_min", "rider_trip_distance_km",
     "tip_inr", "customer_rating_of_delivery", "sla_breach", "delivered_at", "rest_mean_payout"],
)
def test_audit_catches(column):
    assert audit([*HONEST, column]) == [column]
    with pytest.raises(AssertionError):
        assert_no_leakage([*HONEST, column])


def test_catalogue(spark):
    df = spark.createDataFrame([], "distance_km double, picked_up_at string, tip_inr double, is_peak boolean, city string")
    got = {r["column"]: (r["availability"], r["categorical"], r["leaks"]) for r in column_catalogue(spark, df).collect()}
    assert got == {
        "distance_km": ("order_time", False, False),
        "picked_up_at": ("in_progress", False, True),
        "tip_inr": ("post_outcome", False, True),
        "is_peak": ("derived", False, False),
        "city": ("order_time", True, False),
    }


# --- the feature table --------------------------------------------------------------------


def shop(spark, stamp="2025-01-01T10:00:00Z"):
    rows = [("R1", "B", 1.0, 10.0, 4.0, 30.0), ("R1", "A", 2.0, 11.0, 4.5, 31.0), ("R2", "C", 5.0, 9.0, 3.0, 20.0)]
    df = spark.createDataFrame(
        rows, "restaurant_id string, city string, distance_km double, restaurant_prep_min_estimate double, "
        "courier_rating double, promised_eta_min double"
    )
    return order_store(df, F.lit(stamp).cast("timestamp"))


NOW = "2025-01-01T10:01:00Z"


def test_store(spark):
    got = {r["restaurant_id"]: r for r in shop(spark).collect()}
    assert got["R1"]["city"] == "A" and got["R1"]["orders_seen"] == 2
    assert (got["R1"]["distance_km"], got["R1"]["prep_min_estimate"], got["R1"]["courier_rating"]) == (1.5, 10.5, 4.25)
    info = store_info(shop(spark), F.lit(NOW).cast("timestamp")).first()
    assert (info["rows"], info["age_seconds"], info["mixed"]) == (2, 60, False)


def test_freshness(spark):
    now = F.lit(NOW).cast("timestamp")
    assert check_freshness(shop(spark), 120, now) == {"age_seconds": 60, "rows": 2}
    with pytest.raises(StaleStore):
        check_freshness(shop(spark, "2025-01-01T07:00:00Z"), 120, now)


def test_drift(spark):
    old, now = shop(spark), F.lit(NOW).cast("timestamp")
    columns = ["distance_km", "prep_min_estimate", "courier_rating"]
    bad = old.withColumn("distance_km", F.col("distance_km") * 1000).withColumn(
        "prep_min_estimate", F.lit(None).cast("double")
    )
    got = {r["feature"]: r["verdict"] for r in store_drift(old, bad, columns).collect()}
    assert got == {"distance_km": "unit", "prep_min_estimate": "nulls", "courier_rating": "ok"}
    assert store_alarms(old, old, columns, max_age=120, now=now).count() == 0
    stale = old.withColumn("computed_at", F.lit("2025-01-01T04:00:00Z")).withColumn("distance_unit", F.lit("m"))
    found = {tuple(r) for r in store_alarms(old, stale, columns, max_age=120, now=now).collect()}
    assert found == {("computed_at", "stale"), ("distance_unit", "unit")}


# --- reports ------------------------------------------------------------------------------


def test_slices(spark):
    df = spark.range(300).select(
        F.col("id"), F.lit(10.0).alias("p"), F.when(F.col("id") < 150, 10.0).otherwise(14.0).alias("y")
    )
    slices = {"good": F.col("id") < 150, "bad": F.col("id") >= 150, "tiny": F.col("id") < 5}
    report = slice_report(df, slices, "p", "y")
    assert [tuple(r) for r in report.collect()] == [("bad", 150, 4.0, 2.0, -4.0), ("good", 150, 0.0, 0.0, 0.0)]
    assert worst_slice(report).first()["slice"] == "bad" and over_budget(report).count() == 1


def test_shift_day_counts_from_one(spark):
    df = spark.createDataFrame([(274,), (275,)], "doy int")
    assert [r[0] for r in df.select(shift_period()).collect()] == ["before", "after"]


def test_confusion_without_hits(spark):
    df = spark.createDataFrame([(True,), (False,)], "y boolean")
    line = confusion_report(df, {"never": F.lit(False)}, F.col("y")).first()
    assert (line["precision"], line["recall"], line["accuracy"]) == (0.0, 0.0, 0.5)


def test_behaviour(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(10)], "id int, km double")

    def score(rows):
        return rows.withColumn("pred", 10 + F.col("km") - F.when(F.col("km") > 15, 12).otherwise(0))

    assert tuple(never_lower(score_twice(df, score, {"km": F.col("km") * 2})).first()) == (10, 2)
    assert tuple(unchanged(score_twice(df, score, {"id": F.lit(0)})).first()) == (10, 0)
    both = score_twice(df, score, {"km": F.lit(9.0)}, baseline={"km": F.lit(1.0)})
    assert {tuple(r) for r in both.select("pred_a", "pred_b").collect()} == {(11.0, 19.0)}
    assert sorted(r["km"] for r in both.collect()) == [float(i) for i in range(10)]
    assert implausible(score(df), band=(3.0, 12.0)).first()["violations"] == 7


def test_prediction_ratio(spark):
    text = 'before {"eta_minutes": 49.0} 200 after {"eta_minutes":111.7} 200'
    assert spark.createDataFrame([(text,)], "t string").select(prediction_ratio("t")).first()[0] > 1.5


def test_alpha_sweep_moves_the_counters(spark):
    df = spark.range(1000).select(
        (F.col("id") % 2).alias("s"), F.lit(30.0).alias("p"), (F.pmod(F.xxhash64("id"), F.lit(60)) + 1.0).alias("y")
    )
    table = alpha_report(quantile_promises(df, df, "p", "y", "s"), "y").toPandas().sort_values("alpha")
    assert list(table.alpha) == [0.5, 0.6, 0.7, 0.8, 0.9]
    assert table.promises_broken.is_monotonic_decreasing and table.idle_per_1k.is_monotonic_increasing
    assert abs(table.promises_broken.iloc[0] - 0.5) < 0.05


def test_outside_training_range(spark):
    train = spark.createDataFrame([(1.0,), (9.0,)], "km double")
    rows = spark.createDataFrame([(1.0,), (9.5,), (None,)], "km double")
    out = [r["outside"] for r in with_outside(rows, training_ranges(train, {"km": "km"})).collect()]
    assert out == [[], ["km"], []]


def test_fingerprint(spark):
    df = spark.range(2000).select(
        F.col("id").cast("string").alias("order_id"),
        F.timestamp_add("MINUTE", F.col("id"), F.lit("2025-01-01").cast("timestamp_ntz")).alias("placed_utc"),
        (F.col("id") % 7).alias("hour"),
    )
    train, test = df.filter("order_id < '5'"), df.filter("order_id >= '5'")

    def sha(*args, **kw):
        return data_fingerprint(*args, **kw).first()[0]

    base = sha(train, test, ["hour"])
    assert base == sha(train.repartition(3), test, ["hour"]) and len(base) == 12
    assert base != sha(train.limit(1000), test, ["hour"]) and base != sha(train, test, ["hour", "city"])
    changed = train.withColumn("hour", F.col("hour") + 1)
    assert sha(train, test, ["hour"], contents=True) != sha(changed, test, ["hour"], contents=True)
    assert sha(train, test, ["hour"], contents=True) == sha(train.repartition(3), test, ["hour"], contents=True)


# --- empty inputs -------------------------------------------------------------------------


def test_empty_tables(spark):
    full = spark.range(50).select("id", (F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    none = full.filter("v < -1")
    assert attach(full, none.select("k", F.lit(1).alias("z")), "k").filter("z is null").count() == 50
    assert group_quantiles(none, ["k"], "v", {"m": 0.5}).count() == 0
    assert simple_random(none, 5, "id").count() == stratified(none, 5, "id", ["k"]).count() == 0
    assert average_precision(sweep(none, "v", F.col("k") == 1)).first()[0] is None
    assert fit_history(none, ["k"], "v", "h").apply(full).count() == 50


# --- lineage ------------------------------------------------------------------------------


def test_lineage_follows_values_through_every_kind_of_plan(spark):
    orders = spark.createDataFrame([(1, 2.0, 3.0, "a")], "id int, distance_km double, tip_inr double, city string")
    trips = spark.createDataFrame([(1, 5.0)], "id int, courier_wait_min double")
    wait = trips.groupBy("id").agg(F.avg("courier_wait_min").alias("calm"))
    mean = orders.agg(F.avg("tip_inr").alias("m")).scalar()
    built = orders.join(wait, "id").select(
        "id", (F.col("distance_km") * 2).alias("far"), "calm", mean.alias("level"), F.lit(1).alias("one"),
        F.sum("tip_inr").over(Window.partitionBy("city")).alias("habit"), F.explode(F.array("tip_inr")).alias("each"),
    )
    known = column_sources(built)
    assert known == {
        "id": ["id"], "far": ["distance_km"], "calm": ["courier_wait_min"], "level": ["tip_inr"], "one": [], "habit": ["city", "tip_inr"], "each": ["tip_inr"],
    }
    assert set(leaking_sources(built)) == {"calm", "level", "habit", "each"}
    assert leaking_sources(built, ["far", "calm", "level"], train_fitted=["level"]) == {"calm": ["courier_wait_min"]}
    with pytest.raises(AssertionError, match="calm is computed from courier_wait_min"):
        assert_no_leaking_source(built, ["far", "calm"])
    assert_no_leaking_source(built, ["far", "id"])
    # rows chosen by a late column are not values of it; both sides of a union are
    chosen = orders.filter("tip_inr > 0").join(trips.filter("courier_wait_min > 1"), "id", "left_semi").select("distance_km")
    assert column_sources(chosen) == {"distance_km": ["distance_km"]}
    both = orders.select(F.col("distance_km").alias("x")).unionByName(trips.select(F.col("courier_wait_min").alias("x")))
    assert column_sources(both) == {"x": ["courier_wait_min", "distance_km"]}
    doubled = orders.select("distance_km", "tip_inr").mapInPandas(lambda parts: parts, "p double, q double")
    assert column_sources(doubled) == {"p": ["distance_km", "tip_inr"], "q": ["distance_km", "tip_inr"]}
    built.createOrReplaceTempView("built_features")
    assert column_sources(spark.sql("with t as (select calm + 1 as c from built_features) select max(c) as m from t"))["m"] == ["courier_wait_min"]
    # a written result ends the plan, unless its sources were carried along
    assert column_sources(settle(built.select("calm"))) == {"calm": ["calm"]}
    with lineage_kept(spark):
        assert column_sources(settle(settle(built.select(F.col("calm").alias("x"))).select(F.col("x").alias("y")))) == {"y": ["courier_wait_min"]}


# --- mergeable cells, hash trees, group map ------------------------------------------------


@pytest.mark.parametrize("bits", [1, 4, 10])
def test_cells_of_halves_bound_the_exact_sweep(spark, bits):
    random = np.random.default_rng(bits)
    scores = np.concatenate([random.random(400), np.round(random.random(200), 1), [0.0, 1.0, 1.0]])
    rows = [(i, float(s), bool(random.random() < s * 0.4)) for i, s in enumerate(scores)] + [(9000, None, True), (9001, 0.5, None)]
    df = spark.createDataFrame(rows, "id int, s double, y boolean")
    whole = score_cells(df, "s", F.col("y"), bits=bits)
    halves = [score_cells(df.filter(f), "s", F.col("y"), bits=bits) for f in ("id % 2 = 0", "id % 2 = 1")]
    merged = merged_cells(halves[0].unionByName(halves[1]))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert merged.count() <= 2**bits
    swept = sweep(df, "s", F.col("y"))
    exact = average_precision(swept).first()[0]
    for least in (0.05, 0.3, 0.99):
        got = bounded_sweep(merged, least).first()
        recall = recall_at_precision(swept, least).first()["recall"]
        assert got["ap_low"] - 1e-9 <= exact <= got["ap_high"] + 1e-9
        assert got["recall_low"] - 1e-9 <= recall <= got["recall_high"] + 1e-9
    if bits == 10:
        assert got["ap_high"] - got["ap_low"] < 0.1
    none = bounded_sweep(score_cells(df.filter("not y"), "s", F.col("y"), bits=bits)).first()
    assert (none["ap_low"], none["recall_high"], none["threshold"]) == (0.0, 0.0, None)


def test_hash_trees_find_what_changed_and_read_its_range(spark):
    rows = [(k, f"v{k}") for k in range(5000)] + [(None, "n"), (7, "twice"), (7, "twice")]
    old = spark.createDataFrame(rows, "k long, v string")
    options = {"leaf_keys": 16, "fan": 4}

    def found(new):
        trees = [hash_tree(df, "k", ["v"], **options) for df in (old, new)]
        ranges = changed_ranges(*trees, **options)
        return sorted(map(tuple, ranges.collect()), key=str), sorted(map(tuple, changed_rows(old, new, "k", ranges).collect()), key=str)

    assert found(old.repartition(7)) == ([], [])
    ranges, changed = found(old.withColumn("v", F.when(F.col("k") == 4321, "new").otherwise(F.col("v"))))
    assert ranges == [(4320, 4336, 16, 16)] and changed == [(4321, "new", "added"), (4321, "v4321", "removed")]
    ranges, changed = found(old.filter("k is not null").filter("k <> 7 or v <> 'twice'").unionByName(spark.createDataFrame([(90_000, "x")], old.schema)))
    assert [r[:2] for r in ranges] == [(0, 16), (90_000, 90_016), (None, None)]
    assert changed == [(7, "twice", "removed"), (7, "twice", "removed"), (90_000, "x", "added"), (None, "n", "removed")]
    # of a table sorted by its key only the file with the range is read
    path = shared_path(spark, "sorted")
    old.repartitionByRange(8, "k").sortWithinPartitions("k").write.parquet(path)
    stored = spark.read.parquet(path)
    part = stored.filter((F.col("k") >= 4320) & (F.col("k") < 4336))
    assert part.select(F.col("_metadata.file_path")).distinct().count() == 1
    assert "PushedFilters: [IsNotNull(k), GreaterThanOrEqual(k,4320), LessThan(k,4336)]" in plan_of(part)
    assert hash_tree(old.limit(0), "k", ["v"])[0].count() == 0


def test_a_group_is_never_held_whole(spark):
    """A group of 20,000 rows comes in batches of 500 rows at most; the function itself keeps two numbers."""
    rows = spark.range(20_300).select(F.when(F.col("id") < 20_000, 1).when(F.col("id") < 20_200, 2).alias("g"), F.col("id").alias("v"))

    def function(key, batches):
        rows = most = 0
        for batch in batches:
            rows, most = rows + len(batch), max(most, len(batch))
            if rows == len(batch):
                yield pd.DataFrame({"g": [key[0]], "rows": [-1], "most": [0]})  # results may come before the group ends
        yield pd.DataFrame({"g": [key[0]], "rows": [rows], "most": [most]})

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    try:
        got = {(r["g"], r["rows"]): r["most"] for r in map_groups(rows, ["g"], function, "g int, rows long, most long").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {(1, -1): 0, (1, 20_000): 500, (2, -1): 0, (2, 200): 200, (None, -1): 0, (None, 100): 100}
