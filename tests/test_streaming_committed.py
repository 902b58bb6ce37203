"""Streams through manifests, batches by records, closed hours and salted lookups."""

import json

import pytest
from pyspark.sql import functions as F
from test_streaming import CAT, LINE, _land, _rows

from songpulse import schemas, streaming
from songpulse.operators.catalog import HotRequests, catalog_index, enrich, hot_requests
from songpulse.plans.derived import Derived
from songpulse.session import scratch_path
from songpulse.sources import commits, fixtures
from songpulse.sources import landed as landed_source
from songpulse.sources.tweets import classify_lines, line_status, parse_tweets

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "x", "{}", '{"limit":1}', '{"text":"a"}', '{"timestamp_ms":"x","text":"a"}', LINE % 7, "[1]", '{"timestamp_ms":5000,"text":""}']


def test_lines_are_classified_as_they_are_parsed(spark):
    lines = spark.createDataFrame([(x,) for x in [*ODD, None]], "value string")
    got = classify_lines(lines, keep=("value",))
    want = line_status(lines).select("value", "status")
    assert sorted(map(repr, got.select("value", "status").collect())) == sorted(map(repr, want.collect()))
    assert _rows(got.where("status = 'ok'").select("raw_tweet", "tweet_time")) == _rows(parse_tweets(lines))


def test_every_batch_holds_its_counts(spark):
    landing, sink, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    for i in range(3):
        _land(spark, landing, f"f{i}", [*ODD, *[LINE % (i * 10 + j) for j in range(i)]])
    streaming.stream_ingest_counted(spark, f"{landing}/*", sink, ckpt)
    streaming.stream_ingest_counted(spark, f"{landing}/*", sink, ckpt)
    batch = dict(line_status(spark.read.text(f"{landing}/*")).groupBy("status").count().collect())
    found = streaming.read_line_status(spark, sink)
    assert found.select("part").distinct().count() == 3
    assert {r["status"]: r["n"] for r in found.groupBy("status").agg(F.sum("count").alias("n")).collect()} == batch
    assert streaming.read_batches(spark, sink, schemas.RAW_TWEET).count() == batch["ok"]


def test_a_batch_that_died_after_its_manifest_is_not_written_twice(spark, monkeypatch):
    """The manifest is out, the checkpoint has not seen the end of the batch: the restart runs it again."""
    landing, sink, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    _land(spark, landing, "f0", [LINE % 5, "x"])
    real = commits.publish

    def dies_after(*a, **k):
        real(*a, **k)
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(commits, "publish", dies_after)
        with pytest.raises(Exception):
            streaming.stream_ingest_counted(spark, f"{landing}/*", sink, ckpt)
    streaming.stream_ingest_counted(spark, f"{landing}/*", sink, ckpt)
    assert commits.state(spark, sink).version == 1
    assert _rows(streaming.read_batches(spark, sink, schemas.RAW_TWEET)) == [("#nowplaying a by b", 5)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_running_stream_sees_the_new_catalogue(spark, broadcast):
    landing, sink, ckpt, path = (scratch_path(spark, x) for x in ("landing", "sink", "ckpt", "catalog"))
    cat = lambda genre: spark.createDataFrame([(1, "a", "b", genre, 1.0)], CAT)
    if not broadcast:
        spark.conf.set("songpulse.broadcast.maxBytes", "0")
    streaming.publish_catalog(spark, cat("old"), path)
    _land(spark, landing, "f0", [LINE % 5, LINE % 5, "x"])
    q = streaming.stream_enrich_current(spark, f"{landing}/*", sink, ckpt, path, available_now=False, processing_time="0 seconds")
    try:
        q.processAllAvailable()
        streaming.publish_catalog(spark, cat("new"), path)
        _land(spark, landing, "f1", [LINE % 6])
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
        spark.conf.unset("songpulse.broadcast.maxBytes")
    got = [(r["tweet_time"], r["genre"]) for r in streaming.read_batches(spark, sink, schemas.ENRICHED).collect()]
    assert sorted(got) == [(5, "old"), (5, "old"), (6, "new")]
    assert [commits.manifest(spark, sink, v)["details"]["catalog_version"] for v in (1, 2)] == [1, 2]
    counts = {r["status"]: r["n"] for r in streaming.read_line_status(spark, sink).groupBy("status").agg(F.sum("count").alias("n")).collect()}
    assert counts["ok"] == 3 and counts["not_json"] == 1


def test_state_of_closed_hours_goes(spark):
    landing, sink, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    cat = spark.createDataFrame([(1, "a", "b", "G", 1.0)], CAT)
    rows = [(f, LINE % (1000000 + h * 3600)) for h in range(40) for f in (h // 4, h // 4 + h % 2)]
    lines = spark.createDataFrame(rows, "file int, value string")
    streaming.land_in_order(lines, landing, "file")
    q = streaming.stream_genre_hour(spark, f"{landing}/*", sink, ckpt, cat, output_mode="append", watermark="8 hours")
    state = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    got = _rows(spark.read.parquet(sink))
    assert max(state) <= 18 and state[-1] < 14  # of 40 hours
    assert [r[2] for r in got] == [2] * len(got) and 40 - 10 <= len(got) < 40  # late posts counted, open hours not out


def _times(spark, landing):
    """Seconds of modification of the files in each landed folder, in order of the folders."""
    files = spark.read.format("binaryFile").load(f"{landing}/*").select("path", F.unix_seconds("modificationTime").alias("t")).collect()
    folders = sorted({r["path"].split("/")[-2] for r in files})
    return [{r["t"] for r in files if r["path"].split("/")[-2] == f} for f in folders]


@pytest.mark.parametrize("store_keeps_times", [True, False])
def test_folders_land_in_order_in_files_of_several_tasks(spark, monkeypatch, store_keeps_times):
    """A value of many lines is no single file, NULL is a value too, and a store without set times gets copies."""
    if not store_keeps_times:
        monkeypatch.setattr("songpulse.streaming.jobs.set_file_times", lambda *_: False)
    landing = scratch_path(spark, "landing")
    ids = spark.range(0, 60000, 1, 8).withColumn("value", F.sha2(F.col("id").cast("string"), 256))
    size = F.when(F.col("id") % 1000 == 7, F.lit(-2)).when(F.col("id") % 1000 == 8, F.lit(11)).when(F.col("id") % 1000 != 9, F.lit(3))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        landed = streaming.land_in_order(ids.withColumn("file", size), landing, "file")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(landed) == 4 and landed[2] > 2  # NULL, -2, 3, 11
    times = _times(spark, landing)
    assert len(times) == 4 and all(max(a) < min(b) for a, b in zip(times, times[1:]))
    assert [spark.read.text(f"{landing}/{i:06d}").count() for i in range(4)] == [60, 60, 59820, 60]
    assert spark.read.text(f"{landing}/*").select("value").exceptAll(ids.select("value")).count() == 0


def test_batches_over_landed_folders_are_bounded():
    assert streaming.files_per_batch([]) == 1
    assert streaming.files_per_batch([1] * 7) == 1
    assert streaming.files_per_batch([2, 5, 4]) == 5
    assert -(-700 // streaming.files_per_batch([1] * 700)) <= 32


def test_batches_that_end_within_a_folder_lose_no_late_post(spark):
    """Hours as in ``test_state_of_closed_hours_goes``, in folders of several files, some of them in one batch."""
    cat = spark.createDataFrame([(1, "a", "b", "G", 1.0)], CAT)
    rows = [(f, LINE % (1000000 + h * 3600)) for h in range(24) for f in (h // 4, h // 4 + h % 2)] * 50
    lines = spark.createDataFrame(rows, "file int, value string").repartition(4)
    got = []
    for per_batch in (2, 5):
        landing, sink, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1k")
        try:
            assert max(streaming.land_in_order(lines, landing, "file")) > 1
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        streaming.stream_genre_hour(
            spark, f"{landing}/*", sink, ckpt, cat, max_files=per_batch, output_mode="append", watermark="8 hours", state_partitions=2
        )
        got.append(_rows(spark.read.parquet(sink)))
    assert got[0] == got[1] and [r[2] for r in got[0]] == [100] * len(got[0]) and len(got[0]) >= 14


@pytest.mark.parametrize("broadcast", [True, False])
def test_state_stores_are_fewer_where_the_catalogue_is_broadcast(spark, broadcast):
    landing, sink, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    _land(spark, landing, "f0", [LINE % 5])
    cat = spark.createDataFrame([(1, "a", "b", "G", 1.0)], CAT)
    if not broadcast:
        spark.conf.set("songpulse.broadcast.maxBytes", "0")
    try:
        q = streaming.stream_genre_hour(spark, f"{landing}/*", sink, ckpt, cat, state_partitions=3)
    finally:
        spark.conf.unset("songpulse.broadcast.maxBytes")
    stores = {p["stateOperators"][0]["numShufflePartitions"] for p in q.recentProgress if p["stateOperators"]}
    assert stores == {3 if broadcast else int(spark.conf.get("spark.sql.shuffle.partitions"))}
    assert _rows(streaming.read_genre_hour(spark, sink)) == [("G", "01 Jan 1970-00", 1)]


def test_lookup_tables_of_repeated_names_are_measured_as_they_are(spark):
    """A large catalogue of few names has small lookup tables: a stream broadcasts them."""
    cat = spark.range(20000).selectExpr("id", "'a' || id % 5", "'b' || id % 3", "'G'", "1.0D").toDF("track_id", "song", "artist", "genre", "popularity")
    bound = catalog_index(cat, song_only=False).n_bytes
    made = catalog_index(cat, materialize=True, song_only=False)
    assert made.hits.count() == 15 and made.tops.count() == 3
    assert 15 * 128 < made.n_bytes < 10000 < bound
    assert catalog_index(cat.where("track_id < 0"), materialize=True).n_bytes == 0


# ---- admission by records -----------------------------------------------------------------------


def _sizes(q):
    return [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]


def _drain(spark, landing, sink, ckpt, n):
    q = streaming.stream_ingest_records(spark, landing, sink, ckpt, n, processing_time="0 seconds")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return _sizes(q)


def test_batches_end_at_the_number_of_records_across_a_restart(spark):
    landing, sink, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    for i, n in enumerate((10, 3, 17)):
        _land(spark, landing, f"f{i}", [LINE % (100 * i + j) for j in range(n)])
    assert _drain(spark, landing, sink, ckpt, 7) == [7, 7, 7, 7, 2]
    _land(spark, landing, "f3", [LINE % (300 + j) for j in range(9)])
    assert _drain(spark, landing, sink, ckpt, 7) == [7, 2]
    assert _drain(spark, landing, sink, ckpt, 7) == []
    got = [r["tweet_time"] for r in spark.read.parquet(sink).collect()]
    assert sorted(got) == [100 * i + j for i, n in enumerate((10, 3, 17, 9)) for j in range(n)]


def test_a_failed_batch_is_read_again_as_it_was(spark):
    landing, sink, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
    _land(spark, landing, "f0", [LINE % j for j in range(10)])
    seen = []

    def write(batch, n):
        rows = sorted(r["value"] for r in batch.collect())
        seen.append((n, rows))
        if n == 1 and len(seen) == 2:
            raise OSError("lost")

    def run():
        lines = landed_source.stream_records(spark, landing, ckpt, 4)
        q = streaming.run_to_sink(lines, sink, ckpt, available_now=False, processing_time="0 seconds", foreach_batch=write)
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    with pytest.raises(Exception):
        run()
    run()
    assert [n for n, _ in seen] == [0, 1, 1, 2] and seen[1] == seen[2] and [len(r) for _, r in seen] == [4, 4, 4, 2]


def test_files_that_land_before_the_current_one_are_refused(tmp_path):
    (tmp_path / "b").write_text("1\n2\n3\n")
    reader = landed_source.LandedReader({"path": str(tmp_path), "recordsPerBatch": "2"})
    assert reader.latestOffset() == {"file": "b", "at": 4, "files": 0}
    (tmp_path / "a").write_text("0\n")
    with pytest.raises(ValueError, match="landed before b"):
        reader.latestOffset()


@pytest.mark.parametrize("size", [1, 3, 8, 1000])
def test_byte_ranges_give_every_line_once(tmp_path, size):
    texts = ["", "a\n", "\n\nbb\n", "long line é漢\r\nno end", "x\ny\n"]
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}").write_bytes(text.encode())
    want = [x.removesuffix("\r") for t in texts for x in t.removesuffix("\n").split("\n") if t]
    for records in (1, 2, 3, 100):
        reader = landed_source.LandedReader({"path": str(tmp_path), "recordsPerBatch": str(records), "bytesPerPartition": str(size)})
        got, start = [], reader.initialOffset()
        while (end := reader.latestOffset()) != start:
            batch = [v for part in reader.partitions(start, end) for b in reader.read(part) for v in b.column(0).to_pylist()]
            assert len(batch) <= records
            got += batch
            start = end
        assert got == want


# ---- salted lookups -------------------------------------------------------------------------------


@pytest.fixture
def without_aqe(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    saved = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def test_hot_requests_are_spread_without_aqe(spark, without_aqe):
    p = Derived(spark, SF)
    path = scratch_path(spark, "cleaned")
    schemas.conform(p.cleaned, schemas.CLEANED).write.parquet(path)
    cleaned = spark.read.parquet(path)
    row = enrich(cleaned, p.catalog).orderBy("tweet_time").first()
    hot_row = cleaned.where((F.col("raw_tweet") == row["raw_tweet"]) & (F.col("tweet_time") == row["tweet_time"])).limit(1)
    hot = hot_row.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(4000)))).drop("_n")
    skewed = cleaned.unionByName(hot)
    found = hot_requests(skewed)
    key = f"{hot_row.first()['artist'].strip()} {hot_row.first()['song'].strip()}".lower()
    assert key in found.pairs and len(found.pairs) <= 64 and any(a in key for a in found.artists)

    def largest(hot_keys):
        df = enrich(skewed, p.catalog, strategy="direct", hot=hot_keys)
        per_task = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        return _rows(df), max(per_task), df._jdf.queryExecution().executedPlan().toString()

    plain, most, _ = largest(HotRequests())
    salted, spread, plan = largest(found)
    assert salted == plain and "_salt" in plan
    assert most > 4000 and spread < most / 3


def test_no_request_is_hot_in_an_empty_table(spark):
    assert hot_requests(spark.createDataFrame([], schemas.CLEANED)) == HotRequests()


def test_the_hourly_stream_salts_what_is_hot(spark):
    """A large catalogue in a plan with state: the streamed join is salted and gives the same counts."""
    p = Derived(spark, SF)
    landing = scratch_path(spark, "landing")
    lines = [json.dumps({"timestamp_ms": str(t * 1000), "text": "#nowplaying a by b"}) for t in range(2000)]
    _land(spark, landing, "f0", lines)
    streaming.land_lines(fixtures.tweet_lines(p.tweets), f"{landing}/f1")
    cat = p.catalog.unionByName(spark.createDataFrame([(10**9, "a", "b", "G", 1.0)], CAT))
    sinks = []
    for limit in ("0", None):
        sink, ckpt = scratch_path(spark, "sink"), scratch_path(spark, "ckpt")
        if limit:
            spark.conf.set("songpulse.broadcast.maxBytes", limit)
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            streaming.stream_genre_hour(spark, f"{landing}/*", sink, ckpt, cat, max_files=100)
        finally:
            spark.conf.unset("songpulse.broadcast.maxBytes")
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        sinks.append(_rows(streaming.read_genre_hour(spark, sink)))
    assert sinks[0] == sinks[1] and ("G", "01 Jan 1970-00", 2000) in sinks[0]
