"""Parquet and text sinks, and reads of what they wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def append_parquet(df: DataFrame, path: str) -> None:
    """Append; the file commit protocol makes a failed job leave no partial files."""
    df.write.mode("append").parquet(path)


def write_summary_lines(
    lines: DataFrame, path: str, mode: str = "errorifexists", single_file: bool = False
) -> None:
    """Write ``hour,genre,count`` lines as text. ``single_file`` gives one part file (the
    summary is bounded by hours x genres, so one writer task is acceptable when asked for)."""
    out = lines.select(F.col("line").alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).text(path)


def read_summary_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def write_kpis(kpi_long: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One directory per metric holding its value as a line (``metric=<name>/part-*``)."""
    kpi_long.select(F.col("metric"), F.col("value").cast("string").alias("value")).write.mode(
        mode
    ).partitionBy("metric").text(path)


def read_kpis(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.option("basePath", path).text(path)
    return df.select(F.col("metric").cast("string"), F.col("value").cast("bigint"))
