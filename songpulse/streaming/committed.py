"""Streams that write through manifests: exactly-once batches, a catalogue that may change, counted rejects.

Every micro-batch is staged and published as the part ``<stream>-<batch id>`` of a manifest table (see
``sources.commits``), with what was counted while writing it in the manifest's details. A batch
that is run again after a crash finds its part published and is skipped, so rows, counts and the
choice of the catalogue version belong to the batch for good.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from songpulse import schemas
from songpulse.operators.catalog import CatalogIndex, catalog_index, enrich
from songpulse.operators.clean import clean_tweets
from songpulse.sources import commits
from songpulse.sources.tweets import LINE_STATUSES, classify_lines, stream_tweet_lines
from songpulse.streaming.jobs import run_to_sink

CATALOG_PART = "catalog"


def write_batches(
    lines: DataFrame,
    sink: str,
    checkpoint: str,
    batch_rows: Callable[[DataFrame], DataFrame],
    details: Callable[[], dict] = dict,
    stream_id: str = "batch",
    **kw,
) -> StreamingQuery:
    """Post lines -> ``batch_rows`` of the accepted ones, and the counts of all lines by status.

    ``details`` is asked after a batch is staged and adds to its manifest. ``stream_id`` tells streams
    apart that write to one table, each with its own checkpoint.
    """
    counts = [F.count(F.when(F.col("status") == s, 1)).alias(s) for s in LINE_STATUSES]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{stream_id}-{batch_id}"
        table = commits.state(spark, sink)
        if part in table.parts:
            return
        seen = Observation()
        parsed = classify_lines(batch).observe(seen, *counts)
        ok = parsed.where("status = 'ok'").select("raw_tweet", "tweet_time")
        folder = commits.stage_rows(batch_rows(ok), sink)
        made = {"part": part, "line_status": seen.get, **details()}
        while part not in table.parts:  # batches of other streams are no conflict: publish after them
            try:
                table = commits.publish(spark, sink, table, {part: folder}, made)
            except commits.CommitConflict:
                table = commits.state(spark, sink)

    return run_to_sink(lines, sink, checkpoint, foreach_batch=write, **kw)


def stream_ingest_counted(spark, landing, sink, checkpoint, max_files=1, max_bytes=None, **kw) -> StreamingQuery:
    """Landed lines -> (raw_tweet, tweet_time), with every batch's lines counted by status."""
    lines = stream_tweet_lines(spark, landing, max_files, max_bytes)
    return write_batches(lines, sink, checkpoint, lambda ok: schemas.conform(ok, schemas.RAW_TWEET), **kw)


def read_batches(spark: SparkSession, sink: str, schema: StructType) -> DataFrame:
    return commits.read_committed(spark, sink, schema)


def read_line_status(spark: SparkSession, sink: str) -> DataFrame:
    """(part, status, count) of every published batch; statuses without lines count 0."""
    schema = "details struct<part:string,line_status:map<string,bigint>>"
    found = spark.read.schema(schema).json(f"{sink}/_commits/*.json")
    return found.select("details.part", F.explode("details.line_status").alias("status", "count"))


# ---- a catalogue that changes under a running stream --------------------------------------------


def publish_catalog(spark: SparkSession, cat: DataFrame, path: str) -> int:
    """Replace the catalogue table at ``path``; returns its new version."""
    table = commits.state(spark, path)
    folder = commits.stage_rows(schemas.conform(cat, schemas.CATALOG), path)
    return commits.publish(spark, path, table, {CATALOG_PART: folder}).version


class CurrentCatalog:
    """Lookup tables of the newest catalogue version, aggregated once per version and kept for the
    batches until the next one."""

    def __init__(self, path: str):
        self.path, self.version, self.index = path, 0, None

    def get(self, spark: SparkSession) -> CatalogIndex:
        newest = commits.manifests(spark, self.path)[-1]
        if self.index is None or newest != self.version:
            cat = commits.read_committed(spark, self.path, schemas.CATALOG)
            self.index, self.version = catalog_index(cat, materialize=True, song_only=False), newest
        return self.index


def stream_enrich_current(spark, landing, sink, checkpoint, catalog_path, max_files=1, max_bytes=None, **kw) -> StreamingQuery:
    """Landed lines -> enriched rows, each batch by the catalogue version that is newest when it runs.

    A batch is a table of its own here, so the join is planned for it: broadcast, or the distinct
    requests first, as in the batch job. The version used is in the batch's manifest.
    """
    current = CurrentCatalog(catalog_path)

    def rows(ok: DataFrame) -> DataFrame:
        return schemas.conform(enrich(clean_tweets(ok), current.get(ok.sparkSession)), schemas.ENRICHED)

    lines = stream_tweet_lines(spark, landing, max_files, max_bytes)
    return write_batches(lines, sink, checkpoint, rows, lambda: {"catalog_version": current.version}, **kw)
