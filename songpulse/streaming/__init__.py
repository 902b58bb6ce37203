"""Structured Streaming jobs: landed post lines -> parsed, cleaned, enriched, hourly counts."""

from songpulse.streaming.committed import (
    publish_catalog,
    read_batches,
    read_line_status,
    stream_enrich_current,
    stream_ingest_counted,
)
from songpulse.streaming.jobs import (
    files_per_batch,
    land_in_order,
    land_lines,
    read_genre_hour,
    run_to_sink,
    stream_clean,
    stream_enrich,
    stream_genre_hour,
    stream_ingest,
    stream_ingest_records,
)

__all__ = [
    "files_per_batch",
    "land_in_order",
    "land_lines",
    "publish_catalog",
    "read_batches",
    "read_genre_hour",
    "read_line_status",
    "run_to_sink",
    "stream_clean",
    "stream_enrich",
    "stream_enrich_current",
    "stream_genre_hour",
    "stream_ingest",
    "stream_ingest_counted",
    "stream_ingest_records",
]
