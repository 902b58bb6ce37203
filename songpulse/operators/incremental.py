"""Process only new posts: strict high-water mark over what the sink already holds."""

from __future__ import annotations

import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songpulse import schemas
from songpulse.operators.catalog import enrich
from songpulse.sources import commits


def high_water_mark(processed: DataFrame) -> int | None:
    """``max(tweet_time)`` of the processed rows (one value; None when empty).

    On a day-partitioned sink the newest day is found from the partition column alone, and only
    that day's times are read: it holds the maximum, because the day is derived from
    ``tweet_time``.
    """
    if schemas.DAY in processed.columns:
        day = processed.agg(F.max(schemas.DAY)).first()[0]
        if day is not None:
            mark = processed.where(F.col(schemas.DAY) == F.lit(day)).agg(F.max("tweet_time")).first()[0]
            if mark is not None:
                return mark
    return processed.agg(F.max("tweet_time")).first()[0]


def incremental_after(cleaned: DataFrame, processed: DataFrame | None) -> DataFrame:
    """Rows strictly newer than the mark. No sink, or an empty one (NULL mark), means
    everything is new. Equal-second rows after a run are not taken, as in the original.

    The mark is a literal in the filter, so it is pushed into the parquet reader and row
    groups wholly at or below the mark (earlier appends) are skipped from their statistics.
    A day-partitioned input is also pruned to the partitions from the mark's day on.
    """
    return cleaned if processed is None else newer_than(cleaned, high_water_mark(processed))


def newer_than(cleaned: DataFrame, mark: int | None) -> DataFrame:
    """Rows strictly newer than the mark; all of them if there is none."""
    if mark is None:
        return cleaned
    cond = F.col("tweet_time") > F.lit(mark)
    if schemas.DAY in cleaned.columns:
        mark_day = datetime.date(1970, 1, 1) + datetime.timedelta(days=mark // 86400)
        cond = (F.col(schemas.DAY) >= F.lit(mark_day)) & cond
    return cleaned.where(cond)


def read_if_exists(spark: SparkSession, path: str, schema=schemas.ENRICHED) -> DataFrame | None:
    """The sink as a DataFrame, or None when the path does not exist. Other errors surface."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "") == "PATH_NOT_FOUND":
            return None
        raise


def enrich_new(cleaned: DataFrame, processed: DataFrame | None, cat: DataFrame) -> DataFrame:
    """Enriched rows to append: newer than the mark, complete, resolved by the catalogue."""
    return enrich(incremental_after(cleaned, processed), cat)


def append_enriched(
    spark: SparkSession,
    cleaned_path: str,
    sink_path: str,
    cat: DataFrame,
    partition_by_day: bool = False,
) -> None:
    """One incremental run: read the cleaned table, append what is new to the sink.

    A re-run appends nothing twice: committed rows raise the mark. A job that fails before its
    commit leaves no visible files. A commit that itself dies half way may leave some of its
    files visible; these raise the mark, and the next run then skips the rest of that run's
    rows. Where the file system cannot rename a job's output as one, empty the sink's newest
    files before the re-run, or append through a table format with atomic commits. With ``partition_by_day`` the sink is
    written in ``day=`` partitions (a day-partitioned cleaned input is read the same way).
    """
    cleaned = spark.read.schema(schemas.CLEANED).parquet(cleaned_path)
    processed = read_if_exists(spark, sink_path)
    new = schemas.conform(enrich_new(cleaned, processed, cat), schemas.ENRICHED)
    if partition_by_day:
        # Rebalance on the partition column: AQE merges small days and splits big ones to the
        # advisory size, so each day gets a few right-sized files, not one per task.
        out = schemas.with_day(new).hint("rebalance", schemas.DAY)
        out.write.mode("append").partitionBy(schemas.DAY).parquet(sink_path)
    else:
        new.write.mode("append").parquet(sink_path)


def mark_of(table: commits.Table) -> int | None:
    """The high-water mark that the table's last manifest holds; None before the first rows."""
    return table.details.get("mark")


def append_committed(
    spark: SparkSession,
    cleaned_path: str,
    sink_path: str,
    cat: DataFrame,
    partition_by_day: bool = False,
) -> commits.Table:
    """One incremental run whose rows appear all at once, whatever dies on the way.

    The rows are staged in a folder of the run and published by one manifest (see
    ``sources.commits``), which also holds the new mark: the next run reads the mark there, not in
    the data. A run that dies before its manifest leaves no row and no higher mark, so the next
    one takes the same rows again. Of two runs at a time one raises ``CommitConflict``.
    """
    table = commits.state(spark, sink_path)
    cleaned = spark.read.schema(schemas.CLEANED).parquet(cleaned_path)
    new = schemas.conform(enrich(newer_than(cleaned, mark_of(table)), cat), schemas.ENRICHED)
    if partition_by_day:
        folder = commits.stage_rows(schemas.with_day(new).hint("rebalance", schemas.DAY), sink_path, (schemas.DAY,))
    else:
        folder = commits.stage_rows(new, sink_path)
    rows = commits.read_parts(spark, sink_path, {folder: folder}, schemas.ENRICHED)
    n, mark = rows.agg(F.count(F.lit(1)), F.max("tweet_time")).first()
    if not n:
        return table
    return commits.publish(spark, sink_path, table, {folder: folder}, {"mark": mark, "rows": n})


def read_enriched_sink(spark: SparkSession, path: str) -> DataFrame:
    """An enriched sink of either kind: by its manifests if it has any, else all files."""
    if commits.is_committed_table(spark, path):
        return commits.read_committed(spark, path, schemas.ENRICHED)
    return spark.read.schema(schemas.ENRICHED).parquet(path)
