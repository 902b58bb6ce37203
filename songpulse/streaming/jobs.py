"""Streaming forms of the batch jobs.

The source is a directory of landed JSON lines (any connector giving a string ``value`` column
plugs into ``parse_tweets`` the same way). ``max_files`` or ``max_bytes`` cap each micro-batch, the
checkpoint makes a restart resume at the last committed batch, and the parquet file sink is
exactly-once. Tests and the registered queries run with ``availableNow``; production uses a
processing-time trigger (120 s in the original).
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from songpulse import schemas
from songpulse.functions import hour_label
from songpulse.operators.catalog import catalog_index, enrich, hot_requests
from songpulse.operators.clean import clean_tweets
from songpulse.plans.sizing import fits_broadcast
from songpulse.session import child_folders, delete_folder, move_folder, set_file_times
from songpulse.sources.landed import RECORDS_PER_BATCH, stream_records
from songpulse.sources.tweets import parse_tweets, stream_tweet_lines

DEFAULT_TRIGGER = "120 seconds"
#: Bytes of landed lines per file that a micro-batch adds to a day, where its bytes are capped.
FILE_BYTES = 64 << 20
#: Name of the folder of NULL in a partitioned table, and batches over landed folders, each with its fixed costs.
NULL_FOLDER, MOST_BATCHES = "__HIVE_DEFAULT_PARTITION__", 32
#: Share of the landed lines that hot requests are counted in when a stream starts (it only decides what
#: is spread over salts, never a result).
BACKLOG_SHARE, BACKLOG_SEED = 0.02, 7


def land_lines(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Write (event_id, value) lines as text files, one per partition of ``lines``; given
    ``files``, as that many, split by a hash of event_id."""
    dealt = lines.repartition(files, "event_id") if files else lines
    dealt.select("value").write.mode("errorifexists").text(path)


def land_in_order(lines: DataFrame, path: str, by: str) -> list[int]:
    """Write (value, ``by``) lines as a folder of text files per value of ``by`` (an integer; NULL is the first),
    landed in its order: a file source reads files by time of modification, in seconds on some stores. Returns
    the number of files in each folder.

    A value with few lines has one file, one with many is written by several tasks (AQE's advisory
    size). The files are written once and get the times that their order asks for; on a store
    that keeps its own times they are copied, one folder after the other."""
    spark = lines.sparkSession
    staged = f"{path}-staged"
    lines.select("value", by).hint("rebalance", by).write.partitionBy(by).text(staged)
    values = {n: n.split("=", 1)[1] for n in child_folders(spark, staged) if n.startswith(f"{by}=")}
    names = sorted(values, key=lambda n: (values[n] != NULL_FOLDER, int(values[n]) if values[n] != NULL_FOLDER else 0))
    begin = int(time.time()) - len(names)
    kept = all(set_file_times(spark, f"{staged}/{name}", begin + at) for at, name in enumerate(names))
    for at, name in enumerate(names):
        if kept:
            move_folder(spark, f"{staged}/{name}", f"{path}/{at:06d}")
        else:
            spark.read.text(f"{staged}/{name}").write.text(f"{path}/{at:06d}")
            time.sleep(1.1)
    return [sum(n.startswith("part-") for n in child_folders(spark, f"{path}/{at:06d}")) for at in range(len(names))]


def files_per_batch(landed: list[int]) -> int:
    """Files of a micro-batch over folders that ``land_in_order`` made: the largest folder's, or more where there
    are so many folders that the batches would be above ``MOST_BATCHES``."""
    return max([1, *landed, -(-sum(landed) // MOST_BATCHES)])


def run_to_sink(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    output_mode: str = "append",
    available_now: bool = True,
    processing_time: str = DEFAULT_TRIGGER,
    foreach_batch=None,
    start_conf: dict[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> StreamingQuery:
    """Start the query into a parquet sink (or ``foreach_batch``); with ``available_now`` wait
    until every landed file is processed and return the finished query.

    ``start_conf`` is set on the session only around ``start()``: the query runs on a clone of
    the session conf taken there, and the checkpoint keeps it for restarts.
    """
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").option("path", sink)
        if partition_by:
            w = w.partitionBy(*partition_by)
    spark = stream.sparkSession
    saved = {k: spark.conf.get(k, None) for k in (start_conf or {})}
    try:
        for k, v in (start_conf or {}).items():
            spark.conf.set(k, v)
        q = w.start()
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    if available_now:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return q


def _parsed(spark: SparkSession, landing: str, max_files: int | None, max_bytes: int | None) -> DataFrame:
    return parse_tweets(stream_tweet_lines(spark, landing, max_files, max_bytes))


def stream_ingest(spark, landing, sink, checkpoint, max_files=1, max_bytes=None, **kw) -> StreamingQuery:
    """Landed lines -> (raw_tweet, tweet_time) parquet."""
    parsed = _parsed(spark, landing, max_files, max_bytes)
    return run_to_sink(schemas.conform(parsed, schemas.RAW_TWEET), sink, checkpoint, **kw)


def stream_ingest_records(spark, landing, sink, checkpoint, records_per_batch=RECORDS_PER_BATCH, **kw) -> StreamingQuery:
    """Landed lines -> (raw_tweet, tweet_time) parquet, in batches of exactly so many lines (the last one may have fewer).

    Runs on a processing-time trigger (``available_now`` would make one batch of a source of this kind)."""
    parsed = parse_tweets(stream_records(spark, landing, checkpoint, records_per_batch))
    return run_to_sink(schemas.conform(parsed, schemas.RAW_TWEET), sink, checkpoint, available_now=False, **kw)


def stream_clean(
    spark, landing, sink, checkpoint, max_files=1, partition_by_day=False, max_bytes=None, **kw
) -> StreamingQuery:
    """Landed lines -> cleaned table parquet (optionally in ``day=`` partitions, which lets the
    incremental enrichment prune by date).

    By day, a batch of at most ``max_bytes`` adds a file per ``FILE_BYTES`` of them to each day, and as
    many tasks write a day that holds all of the batch; without that cap a day is dealt to all
    shuffle partitions."""
    cleaned = schemas.conform(clean_tweets(_parsed(spark, landing, max_files, max_bytes)), schemas.CLEANED)
    if partition_by_day:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        files = min(partitions, -(-max_bytes // FILE_BYTES)) if max_bytes else partitions
        part = F.pmod(F.xxhash64("raw_tweet", "tweet_time"), F.lit(files))
        dealt = schemas.with_day(cleaned).repartition(F.col(schemas.DAY), part)
        return run_to_sink(dealt, sink, checkpoint, partition_by=[schemas.DAY], **kw)
    return run_to_sink(cleaned, sink, checkpoint, **kw)


def _enriched_stream(spark, landing, cat, max_files, max_bytes) -> tuple[DataFrame, bool]:
    """The enriched rows, and whether the catalogue is broadcast for them."""
    # Stream-static joins. The catalogue lookup tables are aggregated once when the query
    # starts and checkpointed (not re-aggregated every micro-batch); they are broadcast when
    # the catalogue's bytes allow, otherwise each micro-batch is shuffled against them.
    idx = catalog_index(cat, materialize=True, song_only=False)
    cleaned = clean_tweets(_parsed(spark, landing, max_files, max_bytes))
    if fits_broadcast(spark, idx.n_bytes):
        return enrich(cleaned, idx, strategy="broadcast"), True
    # A stream with state is planned without AQE: what is hot among the lines landed so far is salted.
    seen = parse_tweets(spark.read.text(landing).sample(BACKLOG_SHARE, BACKLOG_SEED))
    return enrich(cleaned, idx, strategy="direct", hot=hot_requests(clean_tweets(seen))), False


def stream_enrich(spark, landing, sink, checkpoint, cat, max_files=1, max_bytes=None, **kw) -> StreamingQuery:
    """Landed lines -> enriched table parquet (stream-static join with the catalogue)."""
    enriched, _ = _enriched_stream(spark, landing, cat, max_files, max_bytes)
    out = schemas.conform(enriched, schemas.ENRICHED)
    return run_to_sink(out, sink, checkpoint, **kw)


def genre_hour_stream(enriched: DataFrame, watermark: str | None = "2 hours") -> DataFrame:
    """Hourly (genre, label, count) over event time, with a watermark on the post time when
    ``watermark`` is given (then rows older than it are dropped as late)."""
    ts = F.timestamp_seconds(F.col("tweet_time"))
    timed = enriched.withColumn("ts", ts)
    if watermark:
        timed = timed.withWatermark("ts", watermark)
    counts = (
        timed.groupBy(F.window("ts", "1 hour"), "genre")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return counts.select(
        "genre", hour_label(F.unix_seconds(F.col("window.start"))).alias("tweet_time"), "count"
    )


#: Update batches after which one of them holds the whole result and older folders can go.
COMPACT_EVERY = 50


def stream_genre_hour(
    spark,
    landing,
    sink,
    checkpoint,
    cat,
    max_files=1,
    output_mode="update",
    watermark=None,
    state_partitions=None,
    max_bytes=None,
    compact_every=COMPACT_EVERY,
    **kw,
) -> StreamingQuery:
    """Hourly genre counts as a continuous result.

    ``update`` (default) writes only the (genre, hour) rows a batch changed, into that
    batch's own ``batch=<id>`` folder (a replayed batch rewrites just its folder); readers take
    the latest row per group with ``read_genre_hour``, so no partial result is ever visible.
    Every ``compact_every`` batches the folder holds all groups, and a later batch removes the
    folders before it. Batch ids belong to one checkpoint, so a new checkpoint on a sink that
    holds results is refused.
    Without a watermark no row is ever dropped, so the result equals the batch count even when
    posts arrive out of order; the state has one row per hour and genre seen and is not evicted.
    ``append`` (needs ``watermark``, e.g. "2 hours") emits an hour once the watermark passes
    it, to the file sink; rows older than the watermark are dropped as late, and so is state.

    ``state_partitions``: state stores of the query, each with its own files per batch; default the
    session's shuffle partitions. It counts where the catalogue is broadcast; the joins of a larger one are
    shuffled by the session's number, and so is the state then.
    """
    enriched, broadcast = _enriched_stream(spark, landing, cat, max_files, max_bytes)
    if state_partitions and broadcast:
        kw.setdefault("start_conf", {"spark.sql.shuffle.partitions": str(state_partitions)})
    counts = genre_hour_stream(enriched, watermark)
    if output_mode == "update":
        if child_folders(spark, sink) and not child_folders(spark, f"{checkpoint}/offsets"):
            raise ValueError(f"{sink} holds results of another checkpoint; start a new sink or keep its checkpoint")

        def write_updates(batch: DataFrame, batch_id: int) -> None:
            own = batch.sparkSession
            # Folders before the last whole one of a committed batch are not read again.
            whole = (batch_id - 1) // compact_every * compact_every if batch_id else 0
            for name in child_folders(own, sink):
                if name.startswith("batch=") and int(name[6:]) < whole:
                    delete_folder(own, f"{sink}/{name}")
            if batch_id and batch_id % compact_every == 0 and child_folders(own, sink):
                log = own.read.parquet(sink).where(F.col("batch") < batch_id)
                batch = _latest(log.unionByName(batch.withColumn("batch", F.lit(batch_id))))
            batch.write.mode("overwrite").parquet(f"{sink}/batch={batch_id}")

        return run_to_sink(counts, sink, checkpoint, output_mode="update", foreach_batch=write_updates, **kw)
    if output_mode != "append" or not watermark:
        raise ValueError("append mode needs a watermark; other modes: update")
    return run_to_sink(counts, sink, checkpoint, output_mode="append", **kw)


def _latest(log: DataFrame) -> DataFrame:
    return log.groupBy("genre", "tweet_time").agg(F.max_by("count", "batch").alias("count"))


def read_genre_hour(spark: SparkSession, sink: str) -> DataFrame:
    """Current hourly counts from an ``update``-mode sink: per (genre, hour), the row written
    by the latest batch (a grouped aggregate, no sort)."""
    return _latest(spark.read.parquet(sink))
