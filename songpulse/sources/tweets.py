"""Post lines -> (raw_tweet, tweet_time), and typed reads of the cleaned/enriched tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songpulse import schemas
from songpulse.functions import epoch_seconds


# Stricter than Spark's defaults, closer to a standard JSON parser: no single-quoted strings.
# (Content after a complete object, e.g. '{...} xyz', is still ignored rather than rejected.)
JSON_OPTIONS = {"allowSingleQuotes": "false"}


def parse_tweets(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse JSON post lines from any batch or streaming DataFrame with a string column.

    Blank lines, non-JSON lines, notices without ``text`` and ``timestamp_ms`` that is
    no number or out of range are dropped one by one (the rest of the batch is kept). ``tweet_time`` is epoch ms floored to
    seconds.
    """
    p = F.from_json(F.col(value_col), schemas.TWEET_LINE_DDL, JSON_OPTIONS)
    parsed = df.select(p.alias("_p"), *keep).select(
        F.col("_p.text").alias("raw_tweet"),
        epoch_seconds(F.col("_p.timestamp_ms")).alias("tweet_time"),
        *keep,
    )
    return parsed.where(F.col("raw_tweet").isNotNull() & F.col("tweet_time").isNotNull())


#: What becomes of a line: taken, or why it is dropped.
LINE_STATUSES = ("ok", "blank", "not_json", "no_text", "bad_time")


def classify_lines(df: DataFrame, value_col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """(status, raw_tweet, tweet_time[, keep...]) of every line; the object is parsed once for all three."""
    v, p = F.col(value_col), F.col("_p")
    parsed = df.select(F.from_json(v, schemas.TWEET_LINE_DDL, JSON_OPTIONS).alias("_p"), v, *keep)
    time = epoch_seconds(p["timestamp_ms"])
    status = (
        F.when(p["text"].isNotNull() & time.isNotNull(), "ok")
        .when(v.isNull() | (F.trim(v) == ""), "blank")
        .when(F.json_object_keys(v).isNull(), "not_json")
        .when(p["text"].isNull(), "no_text")
        .otherwise("bad_time")
    )
    return parsed.select(status.alias("status"), p["text"].alias("raw_tweet"), time.alias("tweet_time"), *keep)


def line_status(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``status`` saying what ``parse_tweets`` does with each line: ``ok``, ``blank``,
    ``not_json``, ``no_text`` (e.g. a limit notice) or ``bad_time``. Dropped lines stay
    countable: ``line_status(lines).groupBy("status").count()``. A single-quoted object counts
    as ``no_text``."""
    v = F.col(value_col)
    p = F.from_json(v, schemas.TWEET_LINE_DDL, JSON_OPTIONS)
    status = (
        F.when(v.isNull() | (F.trim(v) == ""), "blank")
        .when(F.json_object_keys(v).isNull(), "not_json")
        .when(p["text"].isNull(), "no_text")
        .when(epoch_seconds(p["timestamp_ms"]).isNull(), "bad_time")
        .otherwise("ok")
    )
    return df.withColumn("status", status)


def read_tweet_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def stream_tweet_lines(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = 1, max_bytes_per_trigger: int | None = None
) -> DataFrame:
    """Landed line files as a stream. The per-batch admission cap is a number of files or, if
    ``max_bytes_per_trigger`` is given , their bytes."""
    reader = spark.readStream.format("text")
    if max_bytes_per_trigger:
        return reader.option("maxBytesPerTrigger", max_bytes_per_trigger).load(path)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).load(path)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CLEANED).parquet(path)


def read_enriched(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ENRICHED).parquet(path)
