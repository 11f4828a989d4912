import pytest
from pyspark.sql import functions as F

from punctual.operators.behaviour import score_twice, unchanged
from punctual.operators.evaluation import regression_report
from punctual.operators.history import build_features
from punctual.plans import training
from punctual.plans.promises import fit_promises, promise_sweep
from punctual.plans.training import (
    SERVING_FEATURES,
    evaluation_bundle,
    feature_bakeoff,
    feature_importances,
    fit_classifier,
    fit_regressor,
    imbalance_bakeoff,
    label_beside_prediction,
    leak_ladder,
    load_model,
    order_reports,
    sampling_bakeoff,
    save_model,
    score,
    serving_frame,
)
from punctual.session import settle, shared_path

SMALL = {"trees": 4, "depth": 3}


@pytest.fixture(scope="module")
def trips(spark):
    """Minutes depend on distance, weather, the restaurant and the hour; no nights in the first third."""
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    rows = spark.range(3000).select(
        F.col("id"),
        F.concat(F.lit("O"), F.col("id")).alias("order_id"),
        F.timestamp_add("MINUTE", F.col("id") * 30, F.lit("2025-01-01").cast("timestamp_ntz")).alias("placed_utc"),
        F.concat(F.lit("R"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40))).alias("restaurant_id"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(40)).alias("r"),
        F.concat(F.lit("C"), F.col("id") % 50).alias("courier_id"),
        F.when(F.col("id") % 4 == 0, "Pune").otherwise("Mumbai").alias("city"),
        F.when(F.col("id") % 5 == 0, "rain").when(F.col("id") % 11 == 0, "heavy_rain").otherwise("clear").alias("weather"),
        (1 + 12 * h).alias("distance_km"),
        (10 + F.col("id") % 9).cast("double").alias("restaurant_prep_min_estimate"),
        (1 + F.col("id") % 6).cast("int").alias("n_items"),
        F.lit(4.2).alias("courier_rating"),
    )
    rows = rows.withColumns({"hour": F.hour("placed_utc"), "dow": F.weekday("placed_utc") + 1, "doy": F.dayofyear("placed_utc")})
    minutes = 10 + 3 * F.col("distance_km") + F.col("r") * 0.8 + F.when(F.col("weather") == "rain", 8).otherwise(0)
    rows = rows.withColumn("actual_minutes", minutes.cast("double"))
    return settle(
        rows.withColumns(
            {
                "promised_eta_min": 14 + 3 * F.col("distance_km"),
                "severely_late": F.col("actual_minutes") > 75,
                "eta_error_min": F.col("actual_minutes") - 20,
                "courier_payout_inr": F.col("actual_minutes") * 2 + F.col("n_items"),
            }
        )
    )


@pytest.fixture(scope="module")
def sides(trips):
    return trips.filter("id < 2400"), trips.filter("id >= 2400")


def test_reports(sides):
    reports = order_reports(*sides, **SMALL)
    line = reports["evaluation"].first()
    assert line["n_train"] == 2400 and line["n_test"] == 600
    assert line["model_mae"] < line["predict_the_mean_mae"] and line["model_r2"] > 0.2
    assert {r["slice"] for r in reports["slices"].collect()} >= {"rain", "clear", "Pune"}


def test_model_save_load_and_behaviour(spark, sides):
    train, test = serving_frame(sides[0]), serving_frame(sides[1])
    model = fit_regressor(train, SERVING_FEATURES, "actual_minutes", **SMALL)
    assert max(feature_importances(model, SERVING_FEATURES).items(), key=lambda x: x[1])[0] == "distance_km"
    scored = score(model, test)
    path, table = shared_path(spark, "model"), shared_path(spark, "models")
    save_model(model, path, evaluation_bundle(scored, train, "actual_minutes", "promised_eta_min"), table, SERVING_FEATURES)
    again = score(load_model(path), test)
    assert scored.select("order_id", "pred").exceptAll(again.select("order_id", "pred")).count() == 0
    assert spark.read.parquet(table).first()["path"] == path
    same = unchanged(score_twice(test, lambda d: score(model, d), {"order_id": F.lit("ORD-XXXX")})).first()
    assert same["violations"] == 0
    assert label_beside_prediction(scored, "actual_minutes", ["placed_utc"]).count() == 5


def test_rare_categories_of_a_wide_column_are_folded(spark, sides):
    wide = [side.withColumn("city", F.concat("city", F.lit("'s "), F.col("id") % 40)) for side in sides]
    model = fit_regressor(wide[0], ["city", "distance_km"], "actual_minutes", **SMALL, most_categories=20)
    scored = score(model, wide[1].withColumn("city", F.when(F.col("id") % 3 > 0, F.col("city"))))
    assert scored.count() == 600 and scored.filter("pred is null").count() == 0
    labels = model.stages[1].labelsArray[0]
    assert len(labels) == 21 and "(other)" in labels
    ids = fit_regressor(wide[0].withColumn("city", F.col("order_id")), ["city"], "actual_minutes", **SMALL)
    assert score(ids, wide[1].withColumn("city", F.col("order_id"))).count() == 600


def test_history_helps(sides):
    base = ["distance_km", "n_items", "courier_rating", "restaurant_prep_min_estimate", "hour", "dow", "city", "weather"]
    train, test = build_features(*sides, histories={"rest_hist_mean": ["restaurant_id"]})
    table = feature_bakeoff(train, test, "actual_minutes", {"base": base, "+history": [*base, "rest_hist_mean"]}, **SMALL)
    got = {r["features"]: r["gain"] for r in table.collect()}
    assert got["base"] == 0 and got["+history"] > 0.5


def test_samplers_feed_the_same_model(sides):
    table = sampling_bakeoff(
        *sides, 500, ts="placed_utc", row_id="order_id", strata=["city", "hour"],
        features=["distance_km", "hour", "weather"], target="actual_minutes", **SMALL,
    )
    got = {r["sample"]: r["train_rows"] for r in table.collect()}
    assert got["convenience"] == got["simple random"] == 500 and abs(got["stratified"] - 500) <= 25


def test_class_weights_catch_more(sides):
    train, test = (d.withColumn("late", F.col("severely_late").cast("int")) for d in sides)
    table = imbalance_bakeoff(train, test, ["distance_km", "hour", "weather"], "late", **SMALL)
    got = {r["model"]: r for r in table.collect()}
    assert got["weighted"]["caught"] >= got["plain"]["caught"]
    best = got["weighted at best threshold"]
    assert best["precision"] >= 0.10 and best["recall"] >= got["weighted"]["recall"]


def test_leak_ladder_falls(trips):
    twins = trips.unionByName(trips.filter("id % 30 = 0").withColumn("order_id", F.concat("order_id", F.lit("t"))))
    table = leak_ladder(
        lambda drop: trips if drop else twins, features=["distance_km", "weather", "hour"], answer="eta_error_min",
        from_answer="courier_payout_inr", history_keys=["restaurant_id", "hour"], target="actual_minutes",
        ts="placed_utc", row_id="order_id", holdout_days=10, **SMALL,
    )
    r2 = [r["r2"] for r in sorted(table.collect(), key=lambda r: r["step"])]
    assert len(r2) == 6 and r2[0] > r2[3] and r2[1] > r2[5] and r2[2] >= r2[3] - 0.02


def test_fits_side_by_side_equal_single_fits(sides):
    """One indexed matrix and threads change no number."""
    sets = {"a": ["distance_km", "city"], "b": ["weather", "distance_km", "hour"]}
    table = {r["features"]: r for r in feature_bakeoff(*sides, "actual_minutes", sets, **SMALL).collect()}
    for name, features in sets.items():
        single = score(fit_regressor(sides[0], features, "actual_minutes", **SMALL), sides[1])
        want = regression_report(single, "pred", "actual_minutes").first()
        assert table[name]["mae"] == pytest.approx(want["mae"], rel=1e-12) and table[name]["r2"] == pytest.approx(want["r2"], rel=1e-12)


@pytest.mark.parametrize("with_base", [True, False])
def test_learned_promises_follow_the_spread(spark, with_base):
    """Level and noise depend on the weather: one shift for all would be wrong in both."""
    u = (F.pmod(F.xxhash64("id"), F.lit(100_003)) + 0.5) / 100_003
    rows = spark.range(12_000).select(
        "id", F.when(F.col("id") % 2 == 0, "rain").otherwise("clear").alias("weather"), (F.col("id") % 7).cast("double").alias("x")
    ).withColumn("y", F.when(F.col("weather") == "rain", 120 + 10 * (u - 0.5)).otherwise(100 + (u - 0.5)))
    rows = settle(rows)
    train, test = rows.filter("id < 8000"), rows.filter("id >= 8000")
    model = fit_promises(train, ["weather", "x"], "y", "id", categorical=["weather"], with_base=with_base, **SMALL)
    promised = model.promise(test.withColumn("weather", F.when(F.col("id") % 1000 > 0, F.col("weather"))))
    for part in (promised, promised.filter("weather = 'rain'"), promised.filter("weather = 'clear'")):
        for r in promise_sweep(part, "y").collect():
            assert r["never_falls"] and abs(r["promises_broken"] - (1 - r["alpha"])) < 0.055
    wide = promise_sweep(promised.filter("weather = 'rain'"), "y").filter("alpha = 0.9").first()["median_promise"]
    assert abs(wide - 124) < 0.7
    assert promise_sweep(promised.limit(0), "y").count() == 5


def test_large_fits_take_equal_rows_together(spark, monkeypatch):
    """More rows than a task takes: a regression gets a row per combination, and both models are the same."""
    i = F.col("id")
    rows = settle(spark.range(0, 2400, 1, 1).select(
        (i % 7).alias("x"), F.concat(F.lit("c"), i % 5).alias("c"), ((i * 7919) % 101 < 3 + (i % 7) * (i % 7) + 9 * (i % 5)).cast("int").alias("late"),
        (3.0 * (i % 7) + (i % 5) * (i % 2) + i % 11).alias("y"),
    )).withColumn("w", F.when(F.col("late") == 1, 4.0).otherwise(1.0))

    def both():
        value = fit_regressor(rows, ["x", "c"], "y", categorical=["c"], **SMALL)
        chance = fit_classifier(rows, ["x", "c"], "late", weight="w", categorical=["c"], **SMALL)
        scored = training.score_class(chance, score(value, rows)).select("x", "c", "pred", "proba").distinct().collect()
        return {(r["x"], r["c"]): (r["pred"], r["proba"]) for r in scored}

    want, seen = both(), []
    for learner in (training.GBTRegressor, training.GBTClassifier):
        fit = learner.fit
        monkeypatch.setattr(learner, "fit", lambda self, df, fit=fit: (seen.append(df.count()), fit(self, df))[1])
    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    got = both()
    assert len(got) == 35 and got.keys() == want.keys()
    for key in want:
        assert got[key] == pytest.approx(want[key], rel=1e-9)
    assert seen == [35, 2400]


def test_large_fits_bin_wide_columns_and_spread_rows(spark, monkeypatch):
    monkeypatch.setattr(training, "ROWS_PER_TASK", 100)
    i = F.col("id")
    rows = spark.range(0, 6000, 1, 1).select((i * 0.5).alias("x"), (i % 2).alias("b"), (i * 2.0 + i % 2).alias("y"))
    parts, n = training.spread(rows)
    assert n == 6000 and parts.groupBy(F.spark_partition_id()).count().count() == 60
    assert parts.exceptAll(rows).count() == 0 and training.spread(rows.limit(0))[1] == 0
    model = fit_regressor(rows, ["x", "b"], "y", categorical=[])
    report = regression_report(score(model, rows), "pred", "y").first()
    assert report["r2"] > 0.95 and report["n"] == 6000
    # a row without x counts as one with a missing value
    assert score(model, rows.withColumn("x", F.lit(None).cast("double"))).filter("pred is null").count() == 0


def test_leak_ladder_labels_once(spark, trips):
    counted = spark.sparkContext.accumulator(0)

    def labelled(drop):
        def seen(x):
            counted.add(1)
            return x

        return trips.withColumn("city", F.udf(seen, "string")("city"))

    leak_ladder(
        labelled, features=["distance_km", "city", "hour"], answer="eta_error_min", from_answer="courier_payout_inr",
        history_keys=["restaurant_id"], target="actual_minutes", ts="placed_utc", row_id="order_id", holdout_days=10, trees=1, depth=1,
    )
    # once with and once without twins
    assert counted.value == 2 * trips.count()
