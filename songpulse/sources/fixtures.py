"""Inputs derived deterministically from the driver tables (see FIXTURES.md).

Every derivation is a Spark plan over the given tables, so its size grows with them; the same
derivations are written in DuckDB SQL in ``songpulse.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songpulse.functions import epoch_ms_from_ntz, epoch_seconds_from_ntz

# Epoch second of 2024-01-16 00:00:00 UTC: rows before it form the "already processed" part.
PROCESSED_BEFORE = 1705363200


def catalog(part: DataFrame) -> DataFrame:
    """Music catalogue (track_id, song, artist, genre, popularity) from ``part``.

    ``#`` is replaced by a space because hashtags are stripped from posts.
    """
    return part.select(
        F.col("p_partkey").alias("track_id"),
        F.col("p_name").alias("song"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit(" ")).alias("artist"),
        F.col("p_type").alias("genre"),
        F.col("p_retailprice").alias("popularity"),
    )


def _s(x: str | Column) -> Column:
    return F.lit(x) if isinstance(x, str) else x


def _cat(*parts: str | Column) -> Column:
    return F.concat(*[_s(p) for p in parts])


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """Input of a fixture as at least one partition per core.

    The driver tables are single row groups, so a scan of one is one task; the fixtures stand
    for landed data of many files. Only fixtures use this; operators take inputs as they are.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def tagged_documents(documents: DataFrame) -> DataFrame:
    """Documents (doc_id, text), every tenth with the hashtag at its end."""
    tag = F.when(F.col("doc_id") % 10 == 0, F.lit(" #NowPlaying")).otherwise(F.lit(""))
    return spread_scan(documents, "doc_id").select("doc_id", F.concat("text", tag).alias("text"))


def tweets(events: DataFrame, part: DataFrame) -> DataFrame:
    """Posts (event_id, user_id, ts, raw_tweet, tweet_time): one per event, about the track
    ``event_id % count(part)``, written in one of eight shapes. The shape moves on by one each
    time the events have gone through the tracks, so a track meets all shapes; a third of
    the posts of shape 4 have no hashtag."""
    n_parts = part.select(F.count(F.lit(1))).scalar()
    turn = F.floor(F.col("event_id") / n_parts).cast("bigint")
    ev = spread_scan(events, "event_id").select(
        "event_id", "user_id", "ts", (F.col("event_id") % n_parts).alias("_pk"), ((F.col("event_id") + turn) % 8).alias("_k")
    )
    tracks = part.select(
        F.col("p_partkey").alias("_pk"),
        F.col("p_name").alias("_s"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit(" ")).alias("_a"),
    )
    s, a, k = F.col("_s"), F.col("_a"), F.col("_k")
    text = (
        F.when(k == 0, _cat("#nowplaying ", s, " by ", a, " from Radio http://t.co/x",
                            F.col("event_id").cast("string")))
        .when(k == 1, _cat("#NowPlaying ", s, " - ", a, " #music"))
        .when(k == 2, _cat("#nowplaying ", s, " by ", a))
        .when(k == 3, _cat(s, " - ", a, " #NOWPLAYING"))
        .when((k == 4) & (F.col("event_id") % 3 == 0), _cat("I love ", s, " @dj"))
        .when(k == 4, _cat("I love ", s, " @dj #nowplaying"))
        .when(k == 5, _cat("#nowplaying ", s, " by from x"))
        .when(k == 6, _cat("#nowplaying ", s, " by Unknown Artist"))
        .otherwise(_cat("#nowplaying Wrong Title by ", a))
    )
    return ev.join(tracks, "_pk").select(
        "event_id",
        "user_id",
        "ts",
        text.alias("raw_tweet"),
        epoch_seconds_from_ntz("ts").alias("tweet_time"),
    )


def tweet_lines(tw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """JSON lines (event_id, value[, keep...]) as a post stream delivers them, with noise: every 50th
    event is a ``{"limit":1}`` notice, every 77th an empty line, every 91st not JSON, every 83rd
    has a time beyond the range of an int."""
    line = F.to_json(
        F.struct(
            epoch_ms_from_ntz("ts").cast("string").alias("timestamp_ms"),
            F.col("raw_tweet").alias("text"),
        )
    )
    eid = F.col("event_id")
    value = (
        F.when(eid % 50 == 0, F.lit('{"limit":1}'))
        .when(eid % 77 == 0, F.lit(""))
        .when(eid % 91 == 0, F.lit("not json"))
        .when(eid % 83 == 0, F.lit('{"timestamp_ms":9999999999999,"text":"#nowplaying a by b"}'))
        .otherwise(line)
    )
    return tw.select("event_id", value.alias("value"), *keep)


def lookup_requests(cat: DataFrame) -> DataFrame:
    """Catalogue lookups in seven shapes (``track_id % 7``): right artist and song; right
    artist, wrong song; artist only; unknown artist; unknown song only; nothing; song only."""
    k = F.col("track_id") % 7
    artist = (
        F.when(k.isin(0, 1, 2), F.col("artist"))
        .when(k == 3, F.lit("Nobody Of That Name"))
        .otherwise(F.lit(""))
    )
    song = (
        F.when(k.isin(0, 6), F.col("song"))
        .when(k == 1, F.lit("A Title Of Someone Else"))
        .when(k == 4, F.lit("No Title At All"))
        .otherwise(F.lit(""))
    )
    return cat.select(
        F.col("track_id").alias("request_id"),
        k.cast("int").alias("case_id"),
        artist.alias("artist_in"),
        song.alias("song_in"),
    )


def genre_requests(cat: DataFrame) -> DataFrame:
    """Genre names as callers type them (``track_id % 6``): as stored; space padded lower
    case; ideographic space and tab around; an unknown name; empty; NULL."""
    k = F.col("track_id") % 6
    g = F.col("genre")
    req = (
        F.when(k == 0, g)
        .when(k == 1, _cat("  ", F.lower(g), "  "))
        .when(k == 2, _cat("　", F.lower(g), "\t"))
        .when(k == 3, _cat(g, " music"))
        .when(k == 4, F.lit(""))
        .otherwise(F.lit(None).cast("string"))
    )
    return cat.select(F.col("track_id").alias("request_id"), req.alias("request"))


def genre_dim_raw(cat: DataFrame) -> DataFrame:
    """Genre dictionary entries (ordinal, name, genre_id) with repeated names, one per track;
    a later ordinal overrides an earlier one, as repeated keys in a dict literal do."""
    return cat.select(
        F.col("track_id").alias("ordinal"),
        F.lower(F.col("genre")).alias("name"),
        (F.col("track_id") + 1000).cast("bigint").alias("genre_id"),
    )


def user_region(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """(user_id, region) through customer -> nation -> region."""
    geo = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey"), F.col("r_name").alias("region")
    )
    return customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"), "region"
    )
