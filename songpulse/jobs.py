"""The jobs, runnable with spark-submit or ``python -m songpulse.jobs``.

  clean     <landing dir> <cleaned sink> <checkpoint>   stream post lines -> cleaned parquet
  ingest    <landing dir> <sink> <checkpoint>           stream post lines in batches of so many records
  enrich    <cleaned dir> <enriched sink> <catalog>     incremental catalogue enrichment; --manifest: appends
                                                        that become visible whole (see sources.commits)
  hours     <enriched sink> <hourly table>              add a manifest sink's new appends to the hourly table
  publish-catalog <catalog> <catalog table>             replace the catalogue table of running streams
  stream-enrich <landing dir> <enriched sink> <checkpoint> <catalog>   stream-static enrichment; with
                                                        --catalog-table each batch takes the newest version
  stream-hours  <landing dir> <hourly sink> <checkpoint> <catalog>     continuous hourly counts
  summarize <cleaned dir> <enriched dir> <out dir>      hourly summary lines + headline totals

The catalogue is a parquet table (track_id, song, artist, genre, popularity); a catalogue table is one made
by publish-catalog.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from songpulse import schemas
from songpulse.operators.hourly_table import update_hourly
from songpulse.operators.incremental import append_committed, append_enriched, read_enriched_sink
from songpulse.operators.summary import genre_hour_count, kpi_counts, kpi_long, summary_lines
from songpulse.sources import sinks
from songpulse.sources.landed import RECORDS_PER_BATCH
from songpulse.sources.tweets import read_cleaned
from songpulse.streaming import (
    publish_catalog,
    stream_clean,
    stream_enrich,
    stream_enrich_current,
    stream_genre_hour,
    stream_ingest_records,
)


def read_catalog(spark: SparkSession, path: str):
    return schemas.conform(spark.read.parquet(path), schemas.CATALOG)


def clean_job(
    spark, landing, sink, checkpoint, max_files=1, available_now=False, partition_by_day=False, max_bytes=None
):
    """Runs until stopped (processing-time trigger) unless ``available_now``."""
    return stream_clean(
        spark, landing, sink, checkpoint, max_files=max_files, available_now=available_now,
        partition_by_day=partition_by_day, max_bytes=max_bytes,
    )


def stream_job(
    spark, job, landing, sink, checkpoint, catalog_path, max_files=1, available_now=False, max_bytes=None, catalog_table=False
):
    """The stream-static jobs; run until stopped unless ``available_now``. ``catalog_table``: the catalogue is a
    published one, and every batch of stream-enrich takes its newest version."""
    if catalog_table:
        return stream_enrich_current(
            spark, landing, sink, checkpoint, catalog_path, max_files=max_files, max_bytes=max_bytes, available_now=available_now
        )
    start = {"stream-enrich": stream_enrich, "stream-hours": stream_genre_hour}[job]
    cat = read_catalog(spark, catalog_path)
    return start(
        spark, landing, sink, checkpoint, cat, max_files=max_files, max_bytes=max_bytes, available_now=available_now
    )


def enrich_job(spark, cleaned_path, sink, catalog_path, partition_by_day=False, manifest=False):
    append = append_committed if manifest else append_enriched
    append(spark, cleaned_path, sink, read_catalog(spark, catalog_path), partition_by_day)


def summarize_job(spark, cleaned_path, enriched_path, out_dir, mode="errorifexists"):
    """``out_dir/summary`` (lines ``hour,genre,count``) and ``out_dir/kpis/metric=<name>``."""
    enriched = read_enriched_sink(spark, enriched_path)
    sinks.write_summary_lines(summary_lines(genre_hour_count(enriched)), f"{out_dir}/summary", mode)
    kpis = kpi_long(kpi_counts(read_cleaned(spark, cleaned_path), enriched))
    sinks.write_kpis(kpis, f"{out_dir}/kpis", mode)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="songpulse.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("clean", "stream-enrich", "stream-hours"):
        c = sub.add_parser(name)
        c.add_argument("landing")
        c.add_argument("sink")
        c.add_argument("checkpoint")
        if name == "clean":
            c.add_argument("--partition-by-day", action="store_true")
        else:
            c.add_argument("catalog")
        if name == "stream-enrich":
            c.add_argument("--catalog-table", action="store_true")
        c.add_argument("--max-files-per-trigger", type=int, default=1)
        c.add_argument("--max-bytes-per-trigger", type=int)
        c.add_argument("--available-now", action="store_true")
    i = sub.add_parser("ingest")
    i.add_argument("landing")
    i.add_argument("sink")
    i.add_argument("checkpoint")
    i.add_argument("--records-per-batch", type=int, default=RECORDS_PER_BATCH)
    h = sub.add_parser("hours")
    h.add_argument("enriched")
    h.add_argument("table")
    k = sub.add_parser("publish-catalog")
    k.add_argument("catalog")
    k.add_argument("table")
    e = sub.add_parser("enrich")
    e.add_argument("--manifest", action="store_true")
    e.add_argument("cleaned")
    e.add_argument("sink")
    e.add_argument("catalog")
    e.add_argument("--partition-by-day", action="store_true")
    s = sub.add_parser("summarize")
    s.add_argument("cleaned")
    s.add_argument("enriched")
    s.add_argument("out_dir")
    s.add_argument("--overwrite", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName(f"songpulse-{a.job}").getOrCreate()
    if a.job == "clean":
        q = clean_job(
            spark, a.landing, a.sink, a.checkpoint, a.max_files_per_trigger, a.available_now, a.partition_by_day,
            a.max_bytes_per_trigger,
        )
        if not a.available_now:
            q.awaitTermination()
    elif a.job.startswith("stream-"):
        q = stream_job(
            spark, a.job, a.landing, a.sink, a.checkpoint, a.catalog, a.max_files_per_trigger, a.available_now,
            a.max_bytes_per_trigger, getattr(a, "catalog_table", False),
        )
        if not a.available_now:
            q.awaitTermination()
    elif a.job == "ingest":
        stream_ingest_records(spark, a.landing, a.sink, a.checkpoint, a.records_per_batch).awaitTermination()
    elif a.job == "hours":
        update_hourly(spark, a.enriched, a.table)
    elif a.job == "publish-catalog":
        publish_catalog(spark, read_catalog(spark, a.catalog), a.table)
    elif a.job == "enrich":
        enrich_job(spark, a.cleaned, a.sink, a.catalog, a.partition_by_day, a.manifest)
    else:
        summarize_job(spark, a.cleaned, a.enriched, a.out_dir, "overwrite" if a.overwrite else "errorifexists")


if __name__ == "__main__":
    main()
