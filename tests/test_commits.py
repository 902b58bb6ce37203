"""Manifest tables: atomic appends, conflicts, crashes, and the hourly table that follows them."""

import pytest
from pyspark.sql import functions as F

from songpulse import schemas
from songpulse.operators import hourly_table, incremental
from songpulse.operators.incremental import append_committed, mark_of, read_enriched_sink
from songpulse.operators.summary import genre_hour_count
from songpulse.plans.derived import Derived
from songpulse.session import child_folders, scratch_path
from songpulse.sources import commits
from songpulse.sources.fixtures import PROCESSED_BEFORE

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _cleaned(spark, p, before=None):
    path = scratch_path(spark, "cleaned")
    cleaned = schemas.conform(p.cleaned, schemas.CLEANED)
    (cleaned.where(F.col("tweet_time") < before) if before else cleaned).write.parquet(path)
    return path


def test_a_commit_killed_between_two_files_leaves_nothing(spark):
    """The job dies after some of its files are in place, its manifest is missing; the next run takes all rows once."""
    p = Derived(spark, SF)
    early, full = _cleaned(spark, p, PROCESSED_BEFORE), _cleaned(spark, p)
    sink = scratch_path(spark, "enriched")
    append_committed(spark, early, sink, p.catalog)
    before = _rows(read_enriched_sink(spark, sink))
    # Task commits of version 2 move each file to its place at once; the last partition fails after the others.
    spark.conf.set("mapreduce.fileoutputcommitter.algorithm.version", "2")
    broken = schemas.conform(p.enriched, schemas.ENRICHED).repartitionByRange(4, "tweet_time")
    late = broken.agg(F.max("tweet_time")).first()[0]
    slow = F.when(F.col("tweet_time") == late, F.raise_error(F.concat(F.lit("dies "), F.expr("java_method('java.lang.Thread', 'sleep', 1500L)").cast("string"))))
    try:
        with pytest.raises(Exception):
            commits.stage_rows(broken.withColumn("genre", F.coalesce(slow.cast("string"), "genre")), sink)
    finally:
        spark.conf.unset("mapreduce.fileoutputcommitter.algorithm.version")
    staged = {n: child_folders(spark, f"{sink}/data/{n}") for n in child_folders(spark, f"{sink}/data")}
    half = [names for n, names in staged.items() if n not in commits.state(spark, sink).parts.values()]
    assert len(half) == 1 and any(x.startswith("part-") for x in half[0]) and "_SUCCESS" not in half[0]
    assert _rows(read_enriched_sink(spark, sink)) == before
    append_committed(spark, full, sink, p.catalog)
    append_committed(spark, full, sink, p.catalog)
    assert _rows(read_enriched_sink(spark, sink)) == _rows(schemas.conform(p.enriched, schemas.ENRICHED))


def test_a_run_that_dies_before_its_manifest_is_taken_again(spark, monkeypatch):
    p = Derived(spark, SF)
    full, sink = _cleaned(spark, p), scratch_path(spark, "enriched")

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "_publish_file", dies)
        with pytest.raises(OSError):
            append_committed(spark, full, sink, p.catalog)
    assert commits.state(spark, sink).version == 0 and len(child_folders(spark, f"{sink}/data")) == 1
    table = append_committed(spark, full, sink, p.catalog, partition_by_day=False)
    assert table.version == 1 and mark_of(table) == p.enriched.agg(F.max("tweet_time")).first()[0]
    assert _rows(read_enriched_sink(spark, sink)) == _rows(schemas.conform(p.enriched, schemas.ENRICHED))
    # What the dead run staged goes, what is published stays.
    assert commits.vacuum(spark, sink, 3600) == [] and len(commits.vacuum(spark, sink, 0)) == 1
    assert read_enriched_sink(spark, sink).count() == p.enriched.count()


def test_of_two_writers_one_publishes(spark):
    sink = scratch_path(spark, "table")
    base = commits.state(spark, sink)
    rows = spark.createDataFrame([("x", 1)], schemas.RAW_TWEET)
    a, b = commits.stage_rows(rows, sink), commits.stage_rows(rows, sink)
    commits.publish(spark, sink, base, {"a": a})
    with pytest.raises(commits.CommitConflict):
        commits.publish(spark, sink, base, {"b": b})
    assert commits.read_committed(spark, sink, schemas.RAW_TWEET).count() == 1
    assert not [n for n in child_folders(spark, f"{sink}/_commits") if n.endswith(".tmp")]


def test_state_is_read_from_the_last_whole_manifest(spark, monkeypatch):
    monkeypatch.setattr(commits, "FULL_EVERY", 4)
    path = scratch_path(spark, "table")
    table = commits.state(spark, path)
    for i in range(11):
        table = commits.publish(spark, path, table, {f"p{i % 6}": f"run={i}"}, {"n": i})
    read = []
    real = commits.manifest
    monkeypatch.setattr(commits, "manifest", lambda s, p, v: read.append(v) or real(s, p, v))
    found = commits.state(spark, path)
    assert read == [8, 9, 10, 11] and found == table
    assert found.parts == {f"p{i}": f"run={i + 6 if i < 5 else i}" for i in range(6)} and found.details == {"n": 10}
    assert commits.state(spark, path, since=9).parts == {"p3": "run=9", "p4": "run=10"}


def test_hourly_table_follows_appends_and_leaves_other_days(spark):
    p = Derived(spark, SF)
    sink, table = scratch_path(spark, "enriched"), scratch_path(spark, "hourly")
    folders = []
    for before in (PROCESSED_BEFORE - 5 * 86400, PROCESSED_BEFORE + 3600, None):
        append_committed(spark, _cleaned(spark, p, before), sink, p.catalog)
        hourly_table.update_hourly(spark, sink, table)
        again = hourly_table.update_hourly(spark, sink, table)
        folders.append(again.parts)
    assert again.version == 3  # an update without new rows publishes nothing
    assert _rows(hourly_table.read_hourly_labels(spark, table)) == _rows(genre_hour_count(p.enriched))
    first, second, third = folders
    assert all(second[d] == f for d, f in first.items() if d < "2024-01-10")
    split = "2024-01-16"  # the second append ends in this day, so the third writes it anew
    assert third[split] != second[split] and all(third[d] == f for d, f in second.items() if d != split)


def test_hourly_update_that_dies_counts_nothing_twice(spark, monkeypatch):
    p = Derived(spark, SF)
    sink, table = scratch_path(spark, "enriched"), scratch_path(spark, "hourly")
    append_committed(spark, _cleaned(spark, p, PROCESSED_BEFORE), sink, p.catalog)
    hourly_table.update_hourly(spark, sink, table)
    append_committed(spark, _cleaned(spark, p), sink, p.catalog)
    with monkeypatch.context() as m:
        m.setattr(commits, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            hourly_table.update_hourly(spark, sink, table)
    hourly_table.update_hourly(spark, sink, table)
    assert _rows(hourly_table.read_hourly_labels(spark, table)) == _rows(genre_hour_count(p.enriched))


def test_plain_sinks_are_read_as_before(spark):
    path = scratch_path(spark, "plain")
    rows = spark.createDataFrame([("r", "p", "a", "s", "g", 1)], schemas.ENRICHED)
    rows.write.parquet(path)
    assert _rows(read_enriched_sink(spark, path)) == _rows(rows)
    assert incremental.newer_than(rows, None) is rows
