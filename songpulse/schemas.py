"""Table schemas and a helper that conforms a DataFrame to one (by column name, with casts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _s(name: str) -> StructField:
    return StructField(name, StringType(), False)


# JSON line of the post stream: only these two fields are read.
TWEET_LINE_DDL = "timestamp_ms string, text string"

RAW_TWEET = StructType([_s("raw_tweet"), StructField("tweet_time", IntegerType(), False)])

CLEANED = StructType(
    [
        _s("raw_tweet"),
        _s("processed_tweet"),
        _s("song"),
        _s("artist"),
        StructField("tweet_time", IntegerType(), False),
    ]
)

# Note the column order: artist before song (the reverse of CLEANED).
ENRICHED = StructType(
    [
        _s("raw_tweet"),
        _s("processed_tweet"),
        _s("artist"),
        _s("song"),
        _s("genre"),
        StructField("tweet_time", IntegerType(), False),
    ]
)

HOUR_PROJECTION = StructType([_s("artist"), _s("song"), _s("genre"), _s("tweet_time")])

HOUR_SUMMARY = StructType(
    [_s("genre"), _s("tweet_time"), StructField("count", LongType(), False)]
)

KPIS = StructType(
    [
        StructField(n, LongType(), False)
        for n in ("raw_tweet", "processed_tweet", "song", "artist", "genre", "song_distinct")
    ]
)

CATALOG = StructType(
    [
        StructField("track_id", LongType(), False),
        _s("song"),
        _s("artist"),
        _s("genre"),
        StructField("popularity", DoubleType(), True),
    ]
)

GENRE_DIM = StructType([_s("name"), StructField("genre_id", IntegerType(), False)])

FEED = StructType(
    [
        StructField(
            "feed",
            StructType(
                [
                    StructField(
                        "entry",
                        ArrayType(
                            StructType(
                                [
                                    StructField(
                                        "title",
                                        StructType([StructField("label", StringType())]),
                                    )
                                ]
                            )
                        ),
                    )
                ]
            ),
        )
    ]
)


DAY = "day"


def with_day(df: DataFrame) -> DataFrame:
    """Adds ``day`` (UTC calendar date of ``tweet_time``) for day-partitioned sinks."""
    return df.withColumn(DAY, F.date_from_unix_date(F.floor(F.col("tweet_time") / 86400).cast("int")))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the schema's columns by name, in schema order, cast to the schema's types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def matches(df: DataFrame, schema: StructType) -> bool:
    """Same column names, order and types as ``schema``; nullability is ignored because
    parquet reads are always nullable."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    return got == want
