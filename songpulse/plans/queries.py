"""Registered queries: name -> fn(spark, sf_dir) -> DataFrame.

Every query reads the driver tables (or data Spark derives from them) in full. Queries that
exercise a sink write to a fresh folder under ``spark.checkpoint.dir`` and return what a
reader sees there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songpulse import schemas
from songpulse.functions import (
    epoch_ms_from_ntz,
    epoch_seconds,
    epoch_seconds_from_ntz,
    hour_label,
    lookup_key,
    strip,
    tokens,
)
from songpulse.operators import catalog as catalog_ops
from songpulse.operators import genres as genre_ops
from songpulse.operators import ranking, summary
from songpulse.operators.clean import with_song_artist
from songpulse.operators import hourly_table
from songpulse.operators.incremental import append_committed, append_enriched, enrich_new, read_enriched_sink
from songpulse.plans.derived import Derived
from songpulse.session import scratch_path
from songpulse.sources import feed, fixtures, sinks
from songpulse.sources.tweets import parse_tweets, read_cleaned, read_enriched
from songpulse import streaming

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn

    return deco


# ---- scalar functions ------------------------------------------------------------------------


def _documents(spark, sf):
    return fixtures.spread_scan(Derived(spark, sf).t.documents, "doc_id")


@query("clean_text")
def q_clean_text(spark, sf):
    docs = _documents(spark, sf)
    return docs.select("doc_id", tokens("text").alias("processed_text"))


@query("strip_text")
def q_strip_text(spark, sf):
    docs = _documents(spark, sf)
    return docs.select("doc_id", strip("text").alias("stripped_text"))


@query("extract_song_artist")
def q_extract(spark, sf):
    tw = Derived(spark, sf).tweets
    return with_song_artist(tw.select("event_id", "raw_tweet"), "raw_tweet").drop("raw_tweet")


@query("lookup_key")
def q_lookup_key(spark, sf):
    c = Derived(spark, sf).cleaned_ids
    return c.select("event_id", lookup_key("artist", "song").alias("lookup_key"))


@query("hour_label")
def q_hour_label(spark, sf):
    ev = Derived(spark, sf).t.events
    t = epoch_seconds_from_ntz("ts")
    return ev.select("event_id", t.alias("tweet_time"), hour_label(t).alias("hour_label"))


@query("epoch_seconds")
def q_epoch_seconds(spark, sf):
    ev = Derived(spark, sf).t.events
    ms = epoch_ms_from_ntz("ts").cast("string")
    return ev.select("event_id", ms.alias("timestamp_ms"), epoch_seconds(ms).alias("tweet_time"))


# ---- sources, projections, filters -------------------------------------------------------------


@query("parse_tweets_json")
def q_parse(spark, sf):
    p = Derived(spark, sf)
    return parse_tweets(fixtures.tweet_lines(p.tweets))


@query("clean_tweets")
def q_clean(spark, sf):
    return Derived(spark, sf).cleaned


@query("complete_tweets")
def q_complete(spark, sf):
    return Derived(spark, sf).complete


@query("hashtag_filter")
def q_hashtag(spark, sf):
    p = Derived(spark, sf)
    posts = p.tweets.select(
        F.lit("tweets").alias("source"), F.col("event_id").alias("post_id"), F.col("raw_tweet").alias("text")
    ).unionByName(
        fixtures.tagged_documents(p.t.documents).select(F.lit("documents").alias("source"), F.col("doc_id").alias("post_id"), "text")
    )
    return posts.where(F.lower("text").contains("#nowplaying")).select("source", "post_id")


@query("lang_filter")
def q_lang(spark, sf):
    return Derived(spark, sf).t.documents.where(F.col("lang") == "en").select("doc_id", "text")


@query("scan_cleaned")
def q_scan_cleaned(spark, sf):
    path = scratch_path(spark, "cleaned")
    schemas.conform(Derived(spark, sf).cleaned, schemas.CLEANED).write.parquet(path)
    return read_cleaned(spark, path)


@query("sink_roundtrip")
def q_sink_roundtrip(spark, sf):
    """Two appends (before / from the split day) read back as one table."""
    path = scratch_path(spark, "cleaned-append")
    cleaned = schemas.conform(Derived(spark, sf).cleaned, schemas.CLEANED)
    sinks.append_parquet(cleaned.where(F.col("tweet_time") < fixtures.PROCESSED_BEFORE), path)
    sinks.append_parquet(cleaned.where(F.col("tweet_time") >= fixtures.PROCESSED_BEFORE), path)
    return read_cleaned(spark, path)


@query("preview_10")
def q_preview(spark, sf):
    """The first ten enriched rows by time (a top-k report: the limit is the feature), with
    every column as tie-break so the ten are deterministic."""
    e = Derived(spark, sf).enriched
    return e.orderBy("tweet_time", "raw_tweet", "processed_tweet", "artist", "song", "genre").limit(10)


@query("hour_projection")
def q_hour_projection(spark, sf):
    return summary.hour_projection(Derived(spark, sf).enriched)


# ---- catalogue lookups and joins ---------------------------------------------------------------


@query("enrich_tweets")
def q_enrich(spark, sf):
    return Derived(spark, sf).enriched


@query("catalog_best_hit")
def q_best_hit(spark, sf):
    return catalog_ops.best_hits(Derived(spark, sf).catalog)


@query("catalog_artist_top")
def q_artist_top(spark, sf):
    return catalog_ops.artist_top(Derived(spark, sf).catalog)


def _lookups(spark, sf, where=None, keep_unmatched=False):
    cat = Derived(spark, sf).catalog
    req = fixtures.lookup_requests(cat)
    if where is not None:
        req = req.where(where)
    return catalog_ops.lookup(req, cat, "artist_in", "song_in", keep_unmatched=keep_unmatched)


@query("lookup_modes")
def q_lookup_modes(spark, sf):
    return _lookups(spark, sf, keep_unmatched=True)


@query("lookup_artist_only")
def q_lookup_artist(spark, sf):
    return _lookups(spark, sf, (strip("song_in") == "") & (strip("artist_in") != ""))


@query("lookup_song_only")
def q_lookup_song(spark, sf):
    return _lookups(spark, sf, (strip("artist_in") == "") & (strip("song_in") != ""))


def _genre_dim(cat):
    return genre_ops.genre_dim(fixtures.genre_dim_raw(cat))


@query("genre_dim_dedupe")
def q_genre_dim(spark, sf):
    return _genre_dim(Derived(spark, sf).catalog)


@query("genre_lookup")
def q_genre_lookup(spark, sf):
    cat = Derived(spark, sf).catalog
    out = genre_ops.lookup_genres(fixtures.genre_requests(cat), _genre_dim(cat))
    return out.select("request_id", "request", "name", "genre_id")


@query("genre_unknown")
def q_genre_unknown(spark, sf):
    cat = Derived(spark, sf).catalog
    out = genre_ops.unknown_genres(fixtures.genre_requests(cat), _genre_dim(cat))
    return out.select("request_id", "request", "name")


@query("feed_top_songs")
def q_feed(spark, sf):
    """Requested genre names -> genre id -> landed feed document -> [song, artist] rows."""
    cat = Derived(spark, sf).catalog
    dim = _genre_dim(cat)
    path = scratch_path(spark, "feed")
    feed.write_feed_docs(feed.build_feed_docs(cat, dim), path)
    return genre_ops.top_10_songs(fixtures.genre_requests(cat), dim, feed.read_feed(spark, path))


@query("chart_compare")
def q_chart_compare(spark, sf):
    p = Derived(spark, sf)
    return ranking.chart_compare(ranking.top_songs_per_genre(p.enriched), ranking.external_chart(p.catalog))


# ---- aggregations and rankings -----------------------------------------------------------------


@query("genre_hour_count")
def q_genre_hour(spark, sf):
    return summary.genre_hour_count(Derived(spark, sf).enriched)


@query("kpi_counts")
def q_kpis(spark, sf):
    p = Derived(spark, sf)
    return summary.kpi_counts(p.tweets, p.enriched)


@query("kpi_long")
def q_kpi_long(spark, sf):
    p = Derived(spark, sf)
    path = scratch_path(spark, "kpis")
    sinks.write_kpis(summary.kpi_long(summary.kpi_counts(p.tweets, p.enriched)), path)
    return sinks.read_kpis(spark, path)


@query("summary_lines")
def q_summary_lines(spark, sf):
    path = scratch_path(spark, "summary")
    sinks.write_summary_lines(summary.summary_lines(summary.genre_hour_count(Derived(spark, sf).enriched)), path)
    return sinks.read_summary_lines(spark, path)


@query("distinct_artists")
def q_distinct_artists(spark, sf):
    return summary.distinct_values(Derived(spark, sf).enriched, "artist")


@query("distinct_genres")
def q_distinct_genres(spark, sf):
    return summary.distinct_values(Derived(spark, sf).enriched, "genre")


@query("genre_timeseries")
def q_timeseries(spark, sf):
    p = Derived(spark, sf)
    hourly = summary.hourly_genre_counts(p.enriched)
    return summary.genre_timeseries(hourly, summary.genre_values(p.catalog))


@query("genre_counts_per_hour")
def q_counts_per_hour(spark, sf):
    hourly = summary.hourly_genre_counts(Derived(spark, sf).enriched)
    return summary.genre_counts_per_hour(hourly).withColumn("genre_counts", F.to_json("genre_counts"))


@query("top_genre_per_hour")
def q_top_genre_hour(spark, sf):
    best = ranking.top_genre_per_hour(summary.hourly_genre_counts(Derived(spark, sf).enriched))
    return best.select("hour_start", hour_label("hour_start").alias("tweet_time"), "genre", "count")


@query("top10_songs_per_genre")
def q_top_songs(spark, sf):
    return ranking.top_songs_per_genre(Derived(spark, sf).enriched)


@query("top10_artists_per_genre")
def q_top_artists(spark, sf):
    return ranking.top_artists_per_genre(Derived(spark, sf).enriched)


@query("top10_songs_catalog")
def q_top_catalog(spark, sf):
    top = ranking.top_tracks_by_popularity(Derived(spark, sf).catalog)
    return top.select("genre", "rank", "track_id", "song", "artist", "popularity")


def _region_counts(spark, sf):
    p = Derived(spark, sf)
    users = fixtures.user_region(p.t.customer, p.t.nation, p.t.region)
    return ranking.genre_region_count(p.enriched_users, users)


@query("genre_region_count")
def q_region(spark, sf):
    return _region_counts(spark, sf)


@query("top_genre_per_region")
def q_top_region(spark, sf):
    return ranking.top_genre_per_region(_region_counts(spark, sf))


# ---- incremental -----------------------------------------------------------------------------


def _processed_sink(spark, cleaned, cat) -> str:
    """Enriched rows of the days before the split, written as the existing sink."""
    path = scratch_path(spark, "enriched")
    early = catalog_ops.enrich(cleaned.where(F.col("tweet_time") < fixtures.PROCESSED_BEFORE), cat)
    schemas.conform(early, schemas.ENRICHED).write.parquet(path)
    return path


@query("incremental_after_hwm")
def q_incremental(spark, sf):
    p = Derived(spark, sf)
    cleaned_path = scratch_path(spark, "cleaned")
    schemas.conform(p.cleaned, schemas.CLEANED).write.parquet(cleaned_path)
    cleaned = read_cleaned(spark, cleaned_path)
    processed = read_enriched(spark, _processed_sink(spark, cleaned, p.catalog))
    return schemas.conform(enrich_new(cleaned, processed, p.catalog), schemas.ENRICHED)


@query("incremental_first_run")
def q_first_run(spark, sf):
    p = Derived(spark, sf)
    cleaned_path = scratch_path(spark, "cleaned")
    schemas.conform(p.cleaned, schemas.CLEANED).write.parquet(cleaned_path)
    sink = scratch_path(spark, "enriched")
    append_enriched(spark, cleaned_path, sink, p.catalog)
    return read_enriched(spark, sink)


@query("enrich_incremental")
def q_enrich_incremental(spark, sf):
    """Run 1 sees the days before the split, run 2 sees everything; the sink ends complete."""
    p = Derived(spark, sf)
    early, full = scratch_path(spark, "cleaned-early"), scratch_path(spark, "cleaned-full")
    schemas.conform(p.cleaned, schemas.CLEANED).write.parquet(full)
    # The early part is cut from the written table, not cleaned a second time.
    read_cleaned(spark, full).where(F.col("tweet_time") < fixtures.PROCESSED_BEFORE).write.parquet(early)
    sink = scratch_path(spark, "enriched")
    append_committed(spark, early, sink, p.catalog)
    append_committed(spark, full, sink, p.catalog)
    return read_enriched_sink(spark, sink)


@query("genre_hour_incremental")
def q_hourly_table(spark, sf):
    """Three appends, each followed by an update of the hourly table that counts only what is new."""
    p = Derived(spark, sf)
    full = scratch_path(spark, "cleaned-full")
    schemas.conform(p.cleaned, schemas.CLEANED).write.parquet(full)
    sink, table = scratch_path(spark, "enriched"), scratch_path(spark, "hourly")
    day = 24 * 3600
    for before in (fixtures.PROCESSED_BEFORE - 5 * day, fixtures.PROCESSED_BEFORE, None):
        cleaned = full
        if before:
            cleaned = scratch_path(spark, "cleaned-early")
            read_cleaned(spark, full).where(F.col("tweet_time") < before).write.parquet(cleaned)
        append_committed(spark, cleaned, sink, p.catalog, partition_by_day=True)
        hourly_table.update_hourly(spark, sink, table)
    return hourly_table.read_hourly_labels(spark, table)


# ---- streaming -------------------------------------------------------------------------------

def _landed(spark, p: Derived) -> str:
    path = scratch_path(spark, "landing")
    streaming.land_lines(fixtures.tweet_lines(p.tweets), path)
    return path


def _stream(spark, sf, job, with_catalog=False, reader=None):
    p = Derived(spark, sf)
    landing = _landed(spark, p)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "stream-ckpt")
    # Landing makes a file per partition, at least one per core: a batch takes a quarter of the cores' files.
    per_batch = max(1, spark.sparkContext.defaultParallelism // 4)
    inputs = [p.catalog] if with_catalog else []
    job(spark, landing, sink, ckpt, *inputs, max_files=per_batch)
    return reader(spark, sink) if reader else spark.read.parquet(sink)


@query("stream_ingest")
def q_stream_ingest(spark, sf):
    return _stream(spark, sf, streaming.stream_ingest)


@query("stream_ingest_records")
def q_stream_ingest_records(spark, sf):
    """Ingest in batches of a fixed number of lines: an eighth of the posts, however files are cut."""
    p = Derived(spark, sf)
    landing = _landed(spark, p)
    sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "stream-ckpt")
    per_batch = p.t.events.count() // 8 + 1
    q = streaming.stream_ingest_records(spark, landing, sink, ckpt, per_batch, processing_time="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.parquet(sink)


@query("stream_clean")
def q_stream_clean(spark, sf):
    return _stream(spark, sf, streaming.stream_clean)


@query("stream_enrich")
def q_stream_enrich(spark, sf):
    return _stream(spark, sf, streaming.stream_enrich, with_catalog=True)


@query("stream_genre_hour")
def q_stream_genre_hour(spark, sf):
    return _stream(spark, sf, streaming.stream_genre_hour, with_catalog=True, reader=streaming.read_genre_hour)


@query("stream_line_status")
def q_stream_line_status(spark, sf):
    """Lines of a stream by what became of them, from the manifests of its batches."""

    def read(spark, sink):
        return streaming.read_line_status(spark, sink).groupBy("status").agg(F.sum("count").alias("count"))

    return _stream(spark, sf, streaming.stream_ingest_counted, reader=read)


@query("stream_enrich_refresh")
def q_stream_enrich_refresh(spark, sf):
    """One running stream: the posts before the split day meet a catalogue of half the tracks, then the
    whole one is published and the other posts land."""
    p = Derived(spark, sf)
    lines = fixtures.tweet_lines(p.tweets, keep=("tweet_time",))
    landing, cat, sink = (scratch_path(spark, x) for x in ("landing", "catalog", "sink"))
    early = F.col("tweet_time") < fixtures.PROCESSED_BEFORE
    streaming.publish_catalog(spark, p.catalog.where(F.col("track_id") % 2 == 0), cat)
    streaming.land_lines(lines.where(early), f"{landing}/early")
    q = streaming.stream_enrich_current(
        spark, f"{landing}/*", sink, scratch_path(spark, "stream-ckpt"), cat, max_files=1000, available_now=False,
        processing_time="0 seconds",
    )
    try:
        q.processAllAvailable()
        streaming.publish_catalog(spark, p.catalog, cat)
        streaming.land_lines(lines.where(~early), f"{landing}/late")
        q.processAllAvailable()
    finally:
        q.stop()
    return streaming.read_batches(spark, sink, schemas.ENRICHED)


@query("stream_genre_hour_closed")
def q_stream_genre_hour_closed(spark, sf):
    """Hours that a watermark of ten days has closed, from files that hold posts of five days and late ones of
    the five days before; state of closed hours is dropped as the stream goes on."""
    p = Derived(spark, sf)
    span = F.floor(F.col("tweet_time") / (5 * 24 * 3600))
    lines = fixtures.tweet_lines(p.tweets, keep=("tweet_time",))
    lines = lines.withColumn("file", (span + F.col("event_id") % 2).cast("long"))
    landing, sink = scratch_path(spark, "landing"), scratch_path(spark, "sink")
    # A batch may end within the files of five days, or hold more: of what follows, nothing is ten days behind it.
    per_batch = streaming.files_per_batch(streaming.land_in_order(lines, landing, "file"))
    # The state has a row per open hour and genre, however many posts: a store per core.
    stores = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    streaming.stream_genre_hour(
        spark, f"{landing}/*", sink, scratch_path(spark, "stream-ckpt"), p.catalog, max_files=per_batch, output_mode="append",
        watermark="10 days", state_partitions=stores,
    )
    return spark.read.parquet(sink)
