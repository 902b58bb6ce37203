"""The hourly genre summary as a table that follows an enriched sink append by append.

Counts per (genre, hour) add up, so a new append only has to be counted itself and added to the days it
touches. The table keeps one folder per day. An update stages new folders for the touched days and
publishes them together with the version of the sink that they include, in one manifest: a run that dies on
the way changes nothing, and no append is counted twice or missed. Days without new rows keep their files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from songpulse import schemas
from songpulse.functions import hour_label
from songpulse.operators.summary import hourly_genre_counts
from songpulse.sources import commits

SCHEMA = StructType([StructField("genre", StringType()), StructField("hour_start", IntegerType()), StructField("count", LongType())])


def _day(col: str):
    return F.date_from_unix_date(F.floor(F.col(col) / 86400).cast("int"))


def update_hourly(spark: SparkSession, enriched_sink: str, path: str) -> commits.Table:
    """Add what was appended to the (manifest) sink since the table's last update."""
    table = commits.state(spark, path)
    since = table.details.get("source_version", 0)
    source = commits.state(spark, enriched_sink, since=since)
    if source.version == since:
        return table
    new = hourly_genre_counts(commits.read_parts(spark, enriched_sink, source.parts, schemas.ENRICHED))
    # Only the new counts are kept for the next steps: one row per genre and hour of the new rows.
    fresh = commits.stage_rows(new, path)
    new = commits.read_parts(spark, path, {fresh: fresh}, SCHEMA)
    days = [str(r[0]) for r in new.select(_day("hour_start")).distinct().collect()]  # calendar days
    old = commits.read_parts(spark, path, {d: table.parts[d] for d in days if d in table.parts}, SCHEMA)
    merged = old.select("genre", "hour_start", "count").unionByName(new).groupBy("genre", "hour_start").agg(F.sum("count").alias("count"))
    # Rebalanced by day: a day gets one file, or a few of the advisory size.
    folder = commits.stage_rows(merged.withColumn(schemas.DAY, _day("hour_start")).hint("rebalance", schemas.DAY), path, (schemas.DAY,))
    parts = {d: f"{folder}/{schemas.DAY}={d}" for d in days}
    return commits.publish(spark, path, table, parts, {"source_version": source.version})


def read_hourly(spark: SparkSession, path: str) -> DataFrame:
    """(genre, hour_start, count) as of the last update."""
    return commits.read_committed(spark, path, SCHEMA).select("genre", "hour_start", "count")


def read_hourly_labels(spark: SparkSession, path: str) -> DataFrame:
    """(genre, tweet_time label, count): the summary as ``summary.genre_hour_count`` gives it."""
    return read_hourly(spark, path).select("genre", hour_label("hour_start").alias("tweet_time"), "count")
