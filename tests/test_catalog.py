"""Catalogue lookups: the original's seven smoke cases, strategies agree, genre dictionary."""

import pytest

from songpulse.operators.catalog import artist_top, best_hits, enrich, lookup
from songpulse.operators.genres import dedupe_last, genre_dim, lookup_genres, top_10_songs, unknown_genres
from songpulse.plans.sizing import BROADCAST_MAX_BYTES_CONF


@pytest.fixture(scope="module")
def cat(spark):
    rows = [
        (1, "Glass Harbor", "Mira Vale", "Pop", 50.0),
        (2, "North", "Mira Vale", "Soul", 90.0),
        (3, "Slow Tide", "Mira Vale", "Pop", 70.0),
        (4, "Glass Harbor", "Someone Else", "Rock", 95.0),
        (5, "Glass Harbor", "mira vale", "Pop", 10.0),
    ]
    return spark.createDataFrame(rows, "track_id long, song string, artist string, genre string, popularity double")


def _lookup(spark, cat, artist, song, strategy="auto"):
    req = spark.createDataFrame([(1, artist, song)], "id int, a string, s string")
    rows = lookup(req, cat, "a", "s", keep_unmatched=True, strategy=strategy).collect()
    r = rows[0]
    return None if r["res_artist"] is None else (r["res_artist"], r["res_song"], r["res_genre"])


@pytest.mark.parametrize("strategy", ["broadcast", "direct", "distinct"])
def test_seven_cases(spark, cat, strategy):
    # 1: both right -> best hit for "mira vale glass harbor" (track 1 beats track 5 on popularity)
    assert _lookup(spark, cat, "Mira Vale", "Glass Harbor", strategy) == ("Mira Vale", "Glass Harbor", "Pop")
    # 2: artist right, song wrong -> artist's most popular song, artist's main genre
    assert _lookup(spark, cat, "Mira Vale", "A Title Of Someone Else", strategy) == ("Mira Vale", "North", "Pop")
    # 3: artist only -> the artist's most popular song with that song's own genre
    assert _lookup(spark, cat, "  Mira Vale ", "", strategy) == ("Mira Vale", "North", "Soul")
    # 4: unknown artist
    assert _lookup(spark, cat, "Nobody Of That Name", None, strategy) is None
    # 5: unknown song only
    assert _lookup(spark, cat, None, "Nobody Of That Name", strategy) is None
    # 6: nothing
    assert _lookup(spark, cat, None, None, strategy) is None
    assert _lookup(spark, cat, " ", "", strategy) is None
    # song only, known: the most popular track with that title
    assert _lookup(spark, cat, "", "glass harbor", strategy) == ("Someone Else", "Glass Harbor", "Rock")


def test_tables(spark, cat):
    hits = {r["key"]: r["track_id"] for r in best_hits(cat).collect()}
    assert hits["mira vale glass harbor"] == 1 and hits["someone else glass harbor"] == 4
    tops = {r["artist_key"]: (r["song"], r["genre"], r["own_genre"]) for r in artist_top(cat).collect()}
    assert tops["mira vale"] == ("North", "Pop", "Soul")


def test_enrich_drops_incomplete_and_unresolved(spark, cat):
    cleaned = spark.createDataFrame(
        [
            ("r1", "p1", "Glass Harbor", "Mira Vale", 10),
            ("r2", "p2", "", "Mira Vale", 11),
            ("r3", "p3", "Glass Harbor", "", 12),
            ("r4", "p4", "x", "Nobody", 13),
            ("r5", "p5", "Wrong", "Mira Vale", 14),
        ],
        "raw_tweet string, processed_tweet string, song string, artist string, tweet_time int",
    )
    got = sorted(tuple(r) for r in enrich(cleaned, cat).collect())
    assert got == [
        ("r1", "p1", "Mira Vale", "Glass Harbor", "Pop", 10),
        ("r5", "p5", "Mira Vale", "North", "Pop", 14),
    ]


def test_strategies_agree_on_fixture(spark):
    from songpulse.plans.derived import Derived

    p = Derived(spark, "/root/testdata/sf0.001")
    a = sorted(map(tuple, enrich(p.cleaned, p.catalog, strategy="broadcast").collect()))
    b = sorted(map(tuple, enrich(p.cleaned, p.catalog, strategy="distinct").collect()))
    assert a == b and len(a) > 0


def test_auto_strategy_respects_bound(spark):
    from songpulse.plans.derived import Derived

    p = Derived(spark, "/root/testdata/sf0.001")
    spark.conf.set(BROADCAST_MAX_BYTES_CONF, "10")
    try:
        plan = enrich(p.cleaned, p.catalog)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(BROADCAST_MAX_BYTES_CONF)
    assert "BroadcastHashJoin" not in plan or "HashAggregate" in plan
    plan_small = enrich(p.cleaned, p.catalog)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan_small


# Repeated names of the original genre dictionary, in literal order, and the
# id each occurrence carries; the later occurrence wins.
GENRE_REPEATS = [
    ("opera", 1028), ("opera", 9),
    ("singer/songwriter", 10), ("singer/songwriter", 1160),
    ("latin jazz", 1111), ("latin jazz", 1115),
    ("soundtrack", 16), ("soundtrack", 1169),
]


def test_dedupe_last_keeps_later_literal(spark):
    raw = spark.createDataFrame(
        [(i, n, g) for i, (n, g) in enumerate(GENRE_REPEATS)], "ordinal int, name string, genre_id int"
    )
    got = {r["name"]: r["genre_id"] for r in dedupe_last(raw).collect()}
    assert got == {"opera": 9, "singer/songwriter": 1160, "latin jazz": 1115, "soundtrack": 1169}


def test_genre_lookup_trim_lower_and_unknown(spark):
    dim = spark.createDataFrame([("hip-hop/rap", 18), ("pop", 14), ("rock", 21)], "name string, genre_id int")
    req = spark.createDataFrame(
        [(1, "pop"), (2, "  HiP-hop/RaP  "), (3, "Rock"), (4, "jazz"), (5, "not a genre"), (6, ""), (7, None)],
        "request_id int, request string",
    )
    found = {r["request_id"]: r["genre_id"] for r in lookup_genres(req, dim).collect()}
    assert found == {1: 14, 2: 18, 3: 21}
    unknown = sorted(r["request_id"] for r in unknown_genres(req, dim).collect())
    assert unknown == [4, 5]


def test_track_without_genre_does_not_enrich(spark):
    cat = spark.createDataFrame([(1, "s", "a", None, 1.0)], "track_id long, song string, artist string, genre string, popularity double")
    cleaned = spark.createDataFrame([("r", "p", "s", "a", 1)], "raw_tweet string, processed_tweet string, song string, artist string, tweet_time int")
    assert enrich(cleaned, cat).count() == 0


def test_dictionary_table_and_top_10_songs(spark):
    entries = spark.createDataFrame([(1, "Pop", 5), (2, "rock", 7), (3, " pop ", 9)], "ordinal int, name string, genre_id long")
    dim = genre_dim(entries)
    assert {r["name"]: r["genre_id"] for r in dim.collect()} == {"pop": 9, "rock": 7}
    feed = spark.createDataFrame([(9, 0, "s - a", 2, "s", "a"), (7, 0, "t", 1, "t", None)], "genre_id long, pos int, label string, n_parts int, song string, artist string")
    ask = lambda *names: spark.createDataFrame([(n,) for n in names], "request string")
    assert [r["label"] for r in top_10_songs(ask(" POP ", "pop"), dim, feed).collect()] == ["s - a"]
    assert top_10_songs(ask("", None, "nothing such"), dim, feed).count() == 0
