import os

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from punctual.operators.runs import compare, latest_runs, leaderboard, run_record
from punctual.plans.formats import race, timed
from punctual.session import shared_path
from punctual.sources.schemas import LABEL_SHEET, RAW_ORDERS
from punctual.sources.tables import (
    append_metrics,
    append_runs,
    file_report,
    read_csv,
    read_orders,
    read_parquet,
    sql_over_file,
    write_csv,
    write_parquet,
)
from punctual.sources.versions import latest_version, publish, read_version


def test_parquet_variants_and_projection(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 3).withColumn("pad", F.lit("same text again and again"))
    zstd, plain = shared_path(spark, "t"), shared_path(spark, "t")
    write_parquet(df, zstd)
    write_parquet(df, plain, compression="none")
    scan = read_parquet(spark, plain, ["x"]).filter("x > 1")
    plan = plan_of(scan)
    assert "ReadSchema: struct<x:bigint>" in plan and "GreaterThan(x,1)" in plan
    a, b = file_report(spark.read.parquet(zstd)).first(), file_report(spark.read.parquet(plain)).first()
    assert a["rows"] == b["rows"] == 1000 and a["columns"] == 3 and a["bytes"] < b["bytes"]
    total = sql_over_file(spark, "select sum(x) as s from {table}", zstd).first()["s"]
    assert total == df.agg(F.sum("x")).first()[0]


def test_nan_measures_are_null_on_read(spark):
    path = shared_path(spark, "orders")
    spark.createDataFrame([("a", float("nan"))], "order_id string, tip_inr double").write.parquet(path)
    assert read_orders(spark, path, RAW_ORDERS).first()["tip_inr"] is None


def test_label_sheet_round_trip(spark):
    path = shared_path(spark, "sheet")
    rows = [("O1", "Pune", 3, "rain", 1.5, 2, 30.0, 31.5, "1"), ("O2", "Goa", 4, "clear", 2.5, 1, 30.0, 29.0, "0")]
    write_csv(spark.createDataFrame(rows, LABEL_SHEET), path)
    back = read_csv(spark, path, LABEL_SHEET, ["order_id", "acceptable"])
    assert sorted(tuple(r) for r in back.collect()) == [("O1", "1"), ("O2", "0")]


def test_versions(spark):
    root = shared_path(spark, "store")
    assert latest_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        read_version(spark, root)
    publish(spark.range(3), root, 1)
    publish(spark.range(5), root, 2)
    publish(spark.range(5), root, 2)
    assert read_version(spark, root).count() == 5 and read_version(spark, root, 1).count() == 3
    assert read_version(spark, root).first()["store_version"] == 2


def test_runs(spark):
    path = shared_path(spark, "runs")
    sha = spark.createDataFrame([("abc",)], "data_sha string")
    for name, mae in (("slim", 6.0), ("base", 5.5), ("slim", 5.9)):
        metrics = spark.createDataFrame([(mae, 0.1)], "mae double, bias double")
        append_runs(run_record(name, {"features": name, "split": "time"}, sha, metrics), path)
    runs = latest_runs(spark.read.parquet(path))
    assert [tuple(r) for r in leaderboard(runs).collect()] == [("base", 5.5, 1.0, "abc"), ("slim", 5.9, 5.9 / 5.5, "abc")]
    same = {r["field"]: r["same"] for r in compare(runs, "base", "slim").collect()}
    assert same == {"features": False, "split": True, "data_sha": True, "mae": False, "bias": True}


def test_metrics_table(spark):
    path = os.path.join(shared_path(spark, "metrics"), "m")
    for i in range(2):
        append_metrics(spark.createDataFrame([(float(i),)], "mae double"), path)
    assert spark.read.json(path).count() == 2


def test_race(spark):
    df = spark.range(300).select((F.col("id") % 3).cast("string").alias("city"), F.col("id").cast("double").alias("km"),
                                 (F.col("id") * 2).cast("double").alias("err"))
    table = race(spark, df, "city", "err", "km", 5, repeats=1).collect()
    assert len(table) == 5 and all(r["rows_out"] == 3 and r["ms"] > 0 for r in table)
    assert min(r["x_fastest"] for r in table) == 1.0


def test_timed_repeats():
    calls = []
    ms, out = timed(lambda: calls.append(1) or 7, repeats=3)
    assert len(calls) == 3 and out == 7 and ms >= 0
