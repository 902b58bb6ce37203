"""High-water-mark runs: first run, empty sink, strict mark, re-run idempotence."""

import pytest

from songpulse import schemas
from songpulse.operators.incremental import append_enriched, incremental_after, read_if_exists
from songpulse.plans.derived import Derived
from songpulse.session import scratch_path
from songpulse.sources.tweets import read_enriched

SF = "/root/testdata/sf0.001"


def test_missing_sink_is_first_run(spark):
    assert read_if_exists(spark, scratch_path(spark, "absent")) is None


def test_other_errors_surface(spark, tmp_path):
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_if_exists(spark, str(bad)).count()


def test_empty_sink_means_everything(spark):
    p = Derived(spark, SF)
    empty = spark.createDataFrame([], schemas.ENRICHED)
    assert incremental_after(p.cleaned, empty).count() == p.cleaned.count()


def test_strict_mark(spark):
    cleaned = spark.createDataFrame([(t,) for t in (5, 9, 10, 11)], "tweet_time int")
    processed = spark.createDataFrame([(t,) for t in (3, 10)], "tweet_time int")
    assert sorted(r[0] for r in incremental_after(cleaned, processed).collect()) == [11]


def test_rerun_appends_nothing(spark):
    p = Derived(spark, SF)
    cleaned_path = scratch_path(spark, "cleaned")
    schemas.conform(p.cleaned, schemas.CLEANED).write.parquet(cleaned_path)
    sink = scratch_path(spark, "enriched")
    append_enriched(spark, cleaned_path, sink, p.catalog)
    n1 = read_enriched(spark, sink).count()
    append_enriched(spark, cleaned_path, sink, p.catalog)
    assert read_enriched(spark, sink).count() == n1 == p.enriched.count()


def test_day_partitioned_run_prunes_and_matches(spark):
    from songpulse.operators.incremental import enrich_new, high_water_mark
    from songpulse.sources.tweets import read_cleaned

    p = Derived(spark, SF)
    cleaned = schemas.conform(p.cleaned, schemas.CLEANED)
    early_path, full_path = scratch_path(spark, "early"), scratch_path(spark, "full")
    from pyspark.sql import functions as F

    schemas.with_day(cleaned.where(F.col("tweet_time") < 1705363200)).write.partitionBy("day").parquet(early_path)
    schemas.with_day(cleaned).write.partitionBy("day").parquet(full_path)
    sink = scratch_path(spark, "enriched")
    append_enriched(spark, early_path, sink, p.catalog, partition_by_day=True)
    processed = read_enriched(spark, sink)
    assert "day" in processed.columns
    assert high_water_mark(processed) == processed.agg(F.max("tweet_time")).first()[0]
    new = enrich_new(read_cleaned(spark, full_path), processed, p.catalog)
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "(day#" in plan
    append_enriched(spark, full_path, sink, p.catalog, partition_by_day=True)
    append_enriched(spark, full_path, sink, p.catalog, partition_by_day=True)
    got = sorted(map(tuple, read_enriched(spark, sink).drop("day").collect()))
    assert got == sorted(map(tuple, p.enriched.collect()))


def test_mark_ignores_day_folders_above_the_sink(spark, tmp_path):
    from songpulse.operators.incremental import high_water_mark

    rows = [("r", "p", "a", "s", "g", t) for t in (1704067200, 1704412800)]
    sink = str(tmp_path / "day=2024-01-01" / "sink")
    schemas.with_day(spark.createDataFrame(rows, schemas.ENRICHED)).write.partitionBy("day").parquet(sink)
    assert high_water_mark(read_if_exists(spark, sink)) == 1704412800
