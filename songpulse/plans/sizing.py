"""Broadcast only behind a checked size; otherwise leave the join to a shuffle.

The size is measured in bytes over the table that the sides to broadcast are aggregated from, and
covers all sides that are broadcast together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_MAX_BYTES_CONF = "songpulse.broadcast.maxBytes"
DEFAULT_BROADCAST_MAX_BYTES = 256 << 20
#: Bytes of a row beside its strings: fixed-width fields, offsets and the hash table's entry.
ROW_OVERHEAD = 128


def fits_broadcast(spark: SparkSession, n_bytes: int) -> bool:
    return n_bytes <= int(spark.conf.get(BROADCAST_MAX_BYTES_CONF, str(DEFAULT_BROADCAST_MAX_BYTES)))


_BOUNDS: dict[tuple, int] = {}


def byte_bound(df: DataFrame, strings: tuple[str, ...]) -> int:
    """Bytes that the rows of ``df`` take with the given string columns (one aggregate).

    Remembered per plan and estimated input size, which Spark takes from the listed files: a table
    that was rewritten or has grown is measured again.
    """
    estimate = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    key = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), estimate, strings)
    if key not in _BOUNDS:
        sizes = [F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in strings]
        row = sum(sizes, F.lit(ROW_OVERHEAD).cast("bigint"))
        _BOUNDS[key] = df.agg(F.sum(row)).first()[0] or 0
    return _BOUNDS[key]
