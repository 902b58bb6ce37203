"""Summaries of the enriched table: hourly genre counts, headline totals, time series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songpulse.functions import hour_label, hour_start


def hour_projection(enriched: DataFrame) -> DataFrame:
    """(artist, song, genre, tweet_time as ``DD Mon YYYY-HH``)."""
    return enriched.select("artist", "song", "genre", hour_label("tweet_time").alias("tweet_time"))


def hourly_genre_counts(enriched: DataFrame) -> DataFrame:
    """(genre, hour_start, count): grouped on the integer hour; labels are made afterwards on
    the (far fewer) groups. Partial aggregation absorbs a hot genre before the shuffle."""
    return enriched.groupBy("genre", hour_start("tweet_time").alias("hour_start")).agg(
        F.count(F.lit(1)).alias("count")
    )


def genre_hour_count(enriched: DataFrame) -> DataFrame:
    """(genre, tweet_time label, count) - the hourly summary."""
    return hourly_genre_counts(enriched).select(
        "genre", hour_label("hour_start").alias("tweet_time"), "count"
    )


def summary_lines(summary: DataFrame) -> DataFrame:
    """``hour,genre,count`` text lines (no quoting, as in the original)."""
    return summary.select(
        F.concat_ws(",", "tweet_time", "genre", F.col("count").cast("string")).alias("line")
    )


def kpi_counts(raw: DataFrame, enriched: DataFrame) -> DataFrame:
    """One row: raw_tweet, processed_tweet, song (a row count, as in the original), artist,
    genre (distinct counts) and song_distinct. One scan of each input; posts are first counted
    per (genre, artist, song), so only the distinct triples are expanded for the three counts.
    ``raw`` is any table with a row per post; cleaning keeps rows one to one, so the posts
    before it are as good, and counting them runs no extraction."""
    raw_n = raw.select(F.count(F.lit(1))).scalar()
    triples = enriched.groupBy("genre", "artist", "song").agg(F.count(F.lit(1)).alias("_n"))
    total = lambda n: F.coalesce(F.sum(n), F.lit(0).cast("bigint"))
    agg = triples.agg(
        total("_n").alias("processed_tweet"),
        total(F.when(F.col("song").isNotNull(), F.col("_n"))).alias("song"),
        F.count_distinct("artist").alias("artist"),
        F.count_distinct("genre").alias("genre"),
        F.count_distinct("song").alias("song_distinct"),
    )
    return agg.select(
        raw_n.cast("bigint").alias("raw_tweet"),
        "processed_tweet",
        "song",
        "artist",
        "genre",
        "song_distinct",
    )


def kpi_long(kpis: DataFrame) -> DataFrame:
    """(metric, value) rows, one per headline total."""
    names = ["raw_tweet", "processed_tweet", "song", "artist", "genre", "song_distinct"]
    return kpis.select(
        F.stack(F.lit(len(names)), *[x for n in names for x in (F.lit(n), F.col(n).cast("bigint"))]).alias(
            "metric", "value"
        )
    )


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def genre_values(genres: DataFrame, col: str = "genre") -> list[str]:
    """Sorted distinct genre names of a dimension, for pivot columns. At most
    ``spark.sql.pivotMaxValues`` are fetched; more is an error, not a truncation."""
    limit = int(genres.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
    rows = genres.select(col).where(F.col(col).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} genres for columns; use hourly_genre_counts, one row per hour and genre")
    return sorted(r[0] for r in rows)


def genre_timeseries(hourly: DataFrame, genres: list[str] | None = None) -> DataFrame:
    """One row per hour (hour_start, tweet_time label) and one count column per genre, 0 where
    a genre had no post.

    Pass ``genres`` (e.g. ``genre_values(catalogue)``) to name the columns from the dimension;
    without it Spark first runs a distinct job over ``hourly`` itself, which recomputes the
    whole upstream plan.
    """
    wide = hourly.groupBy("hour_start").pivot("genre", genres).agg(F.sum("count")).na.fill(0)
    genre_cols = [c for c in wide.columns if c != "hour_start"]
    return wide.select(
        "hour_start",
        hour_label("hour_start").alias("tweet_time"),
        *[F.col(f"`{c}`").cast("bigint").alias(c) for c in genre_cols],
    )


def genre_counts_per_hour(hourly: DataFrame) -> DataFrame:
    """One row per hour (hour_start, tweet_time label, n_genres, genre_counts): a map of the genres that
    have posts in the hour, ordered by name. No job runs while planning and genres have no limit, unlike
    columns; a reader takes an absent genre as 0."""
    entries = F.sort_array(F.collect_list(F.struct("genre", "count")))
    rows = hourly.groupBy("hour_start").agg(entries.alias("_e"))
    return rows.select(
        "hour_start",
        hour_label("hour_start").alias("tweet_time"),
        F.size("_e").alias("n_genres"),
        F.map_from_entries("_e").alias("genre_counts"),
    )
