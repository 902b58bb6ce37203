"""Cleaned-post table: raw text, cleaned text, extracted song and artist, epoch second."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songpulse.functions import tokens
from songpulse.functions.text import cleaned_groups, raw_groups


def clean_tweets(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(raw_tweet, processed_tweet, song, artist, tweet_time[, keep...]) from
    (raw_tweet, tweet_time). Extraction runs on the raw text; each group is cleaned.

    A filter on song or artist stays above the extraction (see ``with_song_artist``), so it does
    not repeat it; unused columns are still pruned."""
    timed = df.select("raw_tweet", F.col("tweet_time").cast("int").alias("tweet_time"), *keep)
    named = with_song_artist(timed, "raw_tweet")
    return named.select(
        "raw_tweet", tokens("raw_tweet").alias("processed_tweet"), "song", "artist", "tweet_time", *keep
    )


def with_song_artist(df: DataFrame, text: str) -> DataFrame:
    """``df`` and the cleaned (song, artist) of the text column, in stages.

    First the raw groups of the cascade, in one regex evaluation per row, then their cleaning. The
    result comes out of a one-row ``inline``: a filter on generated columns
    cannot be pushed below the generator, so the optimizer does not copy the regex chain
    into the predicate, which would run it twice and outgrow the code generator.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    groups = df.select(*cols, raw_groups(text).alias("_g"))
    return groups.select(*cols, F.inline(F.array(cleaned_groups(F.col("_g")))))


def complete_tweets(df: DataFrame) -> DataFrame:
    """Rows naming both a song and an artist (empty string is the missing marker; NULL is
    dropped as well). Over a stored table the filter reaches the parquet reader."""
    return df.where((F.col("song") != "") & (F.col("artist") != ""))
