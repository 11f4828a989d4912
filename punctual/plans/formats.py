"""The same question over several storage formats: do the answers agree, and what does each cost?"""

from __future__ import annotations

import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from punctual.operators.profile import group_mean
from punctual.session import shared_path
from punctual.sources.tables import file_report, read_csv, read_parquet, sql_over_file, write_csv, write_parquet


def write_variants(df: DataFrame, root: str) -> dict[str, str]:
    """The same rows as zstd Parquet, uncompressed Parquet and CSV below ``root``."""
    paths = {name: os.path.join(root, name) for name in ("parquet_zstd", "parquet_plain", "csv")}
    write_parquet(df, paths["parquet_zstd"], compression="zstd")
    write_parquet(df, paths["parquet_plain"], compression="none")
    write_csv(df, paths["csv"])
    return paths


def askers(
    spark: SparkSession, df: DataFrame, paths: dict[str, str], by: str, value: str, limit: str, over: float
) -> dict[str, Callable[[], DataFrame]]:
    """The question put to each variant: mean of ``value`` by ``by`` where ``limit`` exceeds ``over``."""
    columns = [by, limit, value]

    def frame(scan: DataFrame) -> DataFrame:
        return group_mean(scan, [by], value, F.col(limit) > over)

    query = (
        f"select {by}, avg({value}) as mean_{value}, count({value}) as rows "
        f"from {{table}} where {limit} > {float(over)}D group by {by}"
    )
    return {
        "csv": lambda: frame(read_csv(spark, paths["csv"], df.schema, columns)),
        "parquet_zstd": lambda: frame(read_parquet(spark, paths["parquet_zstd"], columns)),
        "parquet_plain": lambda: frame(read_parquet(spark, paths["parquet_plain"], columns)),
        "sql_zstd": lambda: sql_over_file(spark, query, paths["parquet_zstd"]),
        "sql_plain": lambda: sql_over_file(spark, query, paths["parquet_plain"]),
    }


def same_answers(answers: dict[str, DataFrame], by: str, tolerance: float = 1e-9) -> DataFrame:
    """Per group, the answer, and whether all variants agree on it to a relative ``tolerance``."""
    stacked = None
    for name, answer in answers.items():
        measure = next(c for c in answer.columns if c.startswith("mean_"))
        part = answer.select(by, F.lit(name).alias("variant"), F.col(measure).alias("answer"), "rows")
        stacked = part if stacked is None else stacked.unionByName(part)
    return stacked.groupBy(by).agg(
        F.count(F.lit(1)).alias("variants"),
        F.max("answer").alias("answer"),
        F.max("rows").alias("rows"),
        (
            (F.max("answer") - F.min("answer") <= F.abs(F.max("answer")) * tolerance)
            & (F.min("rows") == F.max("rows"))
        ).alias("agree"),
    )


def timed(ask: Callable[[], object], repeats: int = 3) -> tuple[float, object]:
    """Best of ``repeats`` runs in milliseconds, and the result of the last one."""
    best, out = float("inf"), None
    for _ in range(repeats):
        start = time.perf_counter()
        out = ask()
        best = min(best, (time.perf_counter() - start) * 1000)
    return best, out


def race(
    spark: SparkSession, df: DataFrame, by: str, value: str, limit: str, over: float, repeats: int = 3
) -> DataFrame:
    """approach, file_mb, ms, rows_out and the ratio to the fastest."""
    paths = write_variants(df, shared_path(spark, "formats"))
    lines = []
    for name, ask in askers(spark, df, paths, by, value, limit, over).items():
        source = paths[{"sql_zstd": "parquet_zstd", "sql_plain": "parquet_plain"}.get(name, name)]
        size = file_report(spark.read.format("csv" if name == "csv" else "parquet").load(source)).first()["bytes"]
        ms, _ = timed(lambda: ask().write.format("noop").mode("overwrite").save(), repeats)
        lines.append((name, round(size / 1e6, 1), ms, ask().count()))
    fastest = min(line[2] for line in lines)
    table = [(*line, line[2] / fastest) for line in sorted(lines, key=lambda line: line[2])]
    return spark.createDataFrame(table, "approach string, file_mb double, ms double, rows_out long, x_fastest double")
