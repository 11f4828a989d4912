"""Scans and sinks for the file formats in use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from punctual.functions.clean import nan_to_null


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet in any encoding (the codec is in its footer); only ``columns`` are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(spark: SparkSession, path: str, schema: StructType | str, columns: list[str] | None = None) -> DataFrame:
    """CSV with a header and a declared schema, so that no pass over the text is spent on guessing types."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*columns) if columns else df


def read_orders(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Raw orders from Parquet, with NaN measures as null."""
    return nan_to_null(spark.read.schema(schema).parquet(path))


def sql_over_file(spark: SparkSession, query: str, path: str) -> DataFrame:
    """Run SQL straight over Parquet files: ``{table}`` in the query stands for them."""
    return spark.sql(query, table=spark.read.parquet(path))


def sql_over_frame(query: str, df: DataFrame) -> DataFrame:
    """Run SQL over a DataFrame: ``{table}`` in the query stands for it."""
    return df.sparkSession.sql(query, table=df)


def write_parquet(
    df: DataFrame, path: str, *, compression: str = "zstd", partition_by: list[str] = (), mode: str = "error"
) -> None:
    """Parquet with ``zstd``, ``none`` or another codec, optionally in partition folders."""
    writer = df.write.mode(mode).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, *, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Add the rows of a small report to a JSON table."""
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").json(path)


def append_runs(df: DataFrame, path: str) -> None:
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def file_report(df: DataFrame) -> DataFrame:
    """Rows, columns, files and bytes behind a file-based table, one row.

    Sizes come from the file metadata column, so no data column is read.
    """
    files = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    ).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.max("size").alias("size"))
    return files.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
    )
