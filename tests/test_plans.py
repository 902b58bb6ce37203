"""Plan properties the design relies on at scale (checked on small inputs)."""

from pyspark.sql import functions as F

from songpulse import schemas
from songpulse.operators.catalog import enrich
from songpulse.functions.text import extract_song_artist
from songpulse.operators.clean import clean_tweets, complete_tweets, with_song_artist
from songpulse.operators.incremental import incremental_after
from songpulse.operators.ranking import top_songs_per_genre
from songpulse.operators.summary import genre_hour_count
from songpulse.plans.derived import Derived
from songpulse.plans.sizing import BROADCAST_MAX_BYTES_CONF
from songpulse.session import scratch_path
from songpulse.sources.fixtures import spread_scan
from songpulse.sources.tweets import read_cleaned, read_enriched

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _materialised(spark):
    p = Derived(spark, SF)
    path = scratch_path(spark, "cleaned")
    schemas.conform(p.cleaned, schemas.CLEANED).write.parquet(path)
    return p, read_cleaned(spark, path)


def test_broadcast_path_never_shuffles_posts(spark):
    p, cleaned = _materialised(spark)
    plan = _plan(enrich(cleaned, p.catalog))
    # Exchanges exist only on the catalogue side (aggregations feeding broadcasts).
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan


def test_large_catalogue_path_is_exact_under_a_hot_key(spark):
    p, cleaned = _materialised(spark)
    row = cleaned.where(F.col("song") != "").orderBy("tweet_time").first().asDict()
    # A third of all rows become the same post.
    n = cleaned.count()
    hot = spark.range(n // 2).select(
        *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in cleaned.schema.fields]
    )
    skewed = cleaned.unionByName(hot)
    spark.conf.set(BROADCAST_MAX_BYTES_CONF, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = enrich(skewed, p.catalog)
        plan = _plan(big)
        got = sorted(map(tuple, big.collect()))
    finally:
        spark.conf.unset(BROADCAST_MAX_BYTES_CONF)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, enrich(skewed, p.catalog, strategy="broadcast").collect())) == got


def test_top_k_limits_before_the_shuffle(spark):
    plan = _plan(top_songs_per_genre(Derived(spark, SF).enriched))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_counts_aggregate_partially(spark):
    plan = _plan(genre_hour_count(Derived(spark, SF).enriched))
    assert "partial_count" in plan


def test_mark_reaches_parquet_reader(spark):
    p, cleaned = _materialised(spark)
    sink = scratch_path(spark, "enriched")
    schemas.conform(p.enriched, schemas.ENRICHED).where(F.col("tweet_time") < 1704200000).write.parquet(sink)
    plan = _plan(incremental_after(cleaned, read_enriched(spark, sink)))
    assert "PushedFilters: [IsNotNull(tweet_time), GreaterThan(tweet_time," in plan


def test_stored_enrichment_pushes_the_names_down(spark):
    p, cleaned = _materialised(spark)
    plan = _plan(enrich(cleaned, p.catalog))
    assert "Not(EqualTo(song,))" in plan and "Not(EqualTo(artist,))" in plan
    assert "Not(EqualTo(song,))" in _plan(complete_tweets(cleaned))


def test_extraction_runs_once_even_under_a_filter(spark):
    tw = Derived(spark, SF).tweets
    for df in (
        with_song_artist(tw.select("event_id", "raw_tweet"), "raw_tweet"),
        clean_tweets(tw).where("song = '' or artist = ''"),
        complete_tweets(clean_tweets(tw)),
        tw.select(extract_song_artist("raw_tweet").alias("e")),
    ):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        # The whole cascade is one regex evaluation; the other expressions clean its two groups.
        assert "RLIKE" not in plan and "regexp_extract" not in plan and plan.count(r"(?id)#nowplaying(.*.)by(.*?)from") == 1, plan
        assert df.count() >= 0


def test_headline_totals_extract_once(spark):
    from songpulse.plans.queries import q_kpis

    plan = q_kpis(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(r"(?id)#nowplaying(.*.)by(.*?)from") == 1


def test_no_incomplete_post_reaches_the_joins_of_a_large_catalogue(spark):
    p, cleaned = _materialised(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = enrich(cleaned, p.catalog, strategy="direct")
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        want = sorted(map(tuple, enrich(cleaned, p.catalog, strategy="broadcast").collect()))
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Below the joins, right above the stored table.
    assert "NOT (song" in plan and plan.index("NOT (song") < plan.index("Relation")


def test_aqe_splits_a_hot_post(spark):
    p, cleaned = _materialised(spark)
    row = cleaned.where(F.col("song") != "").orderBy("tweet_time").first().asDict()
    hot = spark.range(200_000).select(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in cleaned.schema.fields])
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = enrich(cleaned.unionByName(hot.repartition(8)), p.catalog, strategy="distinct")
        df.count()
        rows = df.select("raw_tweet", "genre")
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "skew=true" in plan


def test_only_fixtures_spread_scans(spark):
    one = spark.read.parquet(f"{SF}/events.parquet")
    assert spread_scan(one, "event_id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    path = scratch_path(spark, "many")
    spark.range(1000).repartition(32).write.parquet(path)
    assert "Exchange" not in _plan(spread_scan(spark.read.parquet(path), "id"))


def test_operators_need_no_fixtures_and_list_no_files():
    import pathlib

    import songpulse

    for f in pathlib.Path(songpulse.__file__).parent.rglob("*.py"):
        text = f.read_text()
        assert "inputFiles" not in text, f
        assert "fixtures" not in text or f.parent.name in ("sources", "plans"), f


def test_no_machine_local_scratch_on_a_cluster():
    import pytest

    from songpulse.session import checkpoint_root

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        checkpoint_root(Session())
