"""Top-k and arg-max reports.

``rank <= k`` over a window lets Spark insert a partial per-group limit before the shuffle
(``WindowGroupLimit``), so a hot group sends at most k rows per map task, not all its rows.
Every order ends in a unique tie-break, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(
    df: DataFrame,
    partition_by: list[str],
    order_by: list[Column],
    k: int,
    rank_col: str = "rank",
    ties: bool = False,
) -> DataFrame:
    """Rows ranked ``<= k`` within each partition; ``ties=True`` uses rank() (ties kept)."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    fn = F.rank() if ties else F.row_number()
    return df.withColumn(rank_col, fn.over(w)).where(F.col(rank_col) <= k)


def top_tracks_by_popularity(cat: DataFrame, k: int = 10) -> DataFrame:
    """Catalogue top-k per genre: popularity desc, track id asc."""
    return top_k(cat, ["genre"], [F.desc("popularity"), F.asc("track_id")], k)


def top_songs_per_genre(enriched: DataFrame, k: int = 10) -> DataFrame:
    """(genre, rank, song, artist, count): most mentioned songs per genre."""
    counts = enriched.groupBy("genre", "song", "artist").agg(F.count(F.lit(1)).alias("count"))
    ranked = top_k(counts, ["genre"], [F.desc("count"), F.asc("song"), F.asc("artist")], k)
    return ranked.select("genre", "rank", "song", "artist", "count")


def top_artists_per_genre(enriched: DataFrame, k: int = 10) -> DataFrame:
    """(genre, rank, artist, count): most mentioned artists per genre."""
    counts = enriched.groupBy("genre", "artist").agg(F.count(F.lit(1)).alias("count"))
    ranked = top_k(counts, ["genre"], [F.desc("count"), F.asc("artist")], k)
    return ranked.select("genre", "rank", "artist", "count")


def top_genre_per_hour(hourly: DataFrame) -> DataFrame:
    """(hour_start, genre, count) of the most mentioned genre(s) in every hour, ties kept."""
    best = top_k(hourly, ["hour_start"], [F.desc("count")], 1, ties=True)
    return best.select("hour_start", "genre", "count")


def genre_region_count(enriched_users: DataFrame, users: DataFrame) -> DataFrame:
    """(region, genre, count). Posts are first counted per (user, genre), so a very active
    user is one row per genre before the join to the (large) user table."""
    per_user = enriched_users.groupBy("user_id", "genre").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_user.join(users, "user_id")
        .groupBy("region", "genre")
        .agg(F.sum("n").cast("bigint").alias("count"))
    )


def top_genre_per_region(region_counts: DataFrame) -> DataFrame:
    best = top_k(region_counts, ["region"], [F.desc("count")], 1, ties=True)
    return best.select("region", "genre", "count")


def external_chart(cat: DataFrame, k: int = 10) -> DataFrame:
    """(genre, song, artist, chart_rank): top-k distinct (song, artist) per genre by their
    best popularity."""
    distinct_tracks = cat.groupBy("genre", "song", "artist").agg(F.max("popularity").alias("popularity"))
    ranked = top_k(
        distinct_tracks, ["genre"], [F.desc("popularity"), F.asc("song"), F.asc("artist")], k, "chart_rank"
    )
    return ranked.select("genre", "song", "artist", "chart_rank")


def chart_compare(tweet_top: DataFrame, chart: DataFrame) -> DataFrame:
    """Full outer join of the post ranking and an external chart on (genre, song, artist);
    ``rank_delta`` = chart rank - post rank where both exist."""
    t = tweet_top.select("genre", "song", "artist", F.col("rank").alias("tweet_rank"))
    j = t.join(chart, ["genre", "song", "artist"], "full_outer")
    return j.select(
        "genre",
        "song",
        "artist",
        F.col("tweet_rank").cast("int"),
        F.col("chart_rank").cast("int"),
        (F.col("chart_rank") - F.col("tweet_rank")).cast("int").alias("rank_delta"),
    )
