"""Hand-written rows for the scalar functions (cleaning, extraction, labels, epochs)."""

import pytest
from pyspark.sql import functions as F

from songpulse.functions import epoch_seconds, hour_label, lookup_key, strip, tokens
from songpulse.functions.text import extract_song_artist


def _one(spark, expr, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(expr).collect()]


CLEAN_CASES = [
    ("", ""),
    ("#only", ""),
    ("# a", "# a"),
    ("a #b c", "a  c"),
    ("don't $5 - ok?", "dont 5  ok"),
    ("x http://t.co/1 y", "x  y"),
    ("mailhttpx z", "mail z"),
    ("http z", "http z"),
    ("@u hi", "hi"),
    ("a@b c", "a c"),
    ("\xa0\u3000 padded text \u2028\xa0", "padded text"),
    ('say "hi" \\ back', "say hi  back"),
    ("ht-tp://x y", "y"),
    ("a\x00b", "a000b"),
]


@pytest.mark.parametrize("raw,want", CLEAN_CASES)
def test_tokens(spark, raw, want):
    assert _one(spark, tokens("x"), [raw]) == [want]


def test_strip_unicode_whitespace(spark):
    vals = [" a ", "\t\n\x0b\x0c\r a \x1c\x1d\x1e\x1f", "\x85a\u180e", "\u2000a\u200a", "\u200ba\u200b"]
    assert _one(spark, strip("x"), vals) == ["a", "a", "a", "a", "\u200ba\u200b"]


EXTRACT_CASES = [
    ("#nowplaying Baby by by Me from X", ("Baby by", "Me")),
    ("#nowplaying don't-stop - Mac", ("dontstop", "Mac")),
    ("#nowplaying by Q", ("", "Q")),
    ("a-b #nowplaying x by y", ("x", "y")),
    ("line1 - z\nfoo - bar #nowplaying", ("foo", "bar")),
    ("#NOWPLAYING Song BY Artist", ("Song", "Artist")),
    ("#nowplaying A - B by C from D", ("A  B", "C")),
    ("#nowplaying", ("", "")),
    ("#nowplaying S by from x", ("S", "")),
    ("#nowplaying Song\u2028x by Art", ("Song\u2028x", "Art")),
    ("#nowplaying So\nng by Art", ("", "")),
    ("no tag here - at all", ("", "")),
]


@pytest.mark.parametrize("raw,want", EXTRACT_CASES)
def test_extract(spark, raw, want):
    got = _one(spark, extract_song_artist("x"), [raw])[0]
    assert (got["song"], got["artist"]) == want


def test_extract_null_text(spark):
    got = _one(spark, extract_song_artist("x"), [None])[0]
    assert (got["song"], got["artist"]) == ("", "")


def test_hour_label_in_any_session_zone(spark):
    vals = [0, 1704067800, 1709251199, -1]
    want = ["01 Jan 1970-00", "01 Jan 2024-00", "29 Feb 2024-23", "31 Dec 1969-23"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert _one(spark, hour_label("x"), vals, "x bigint") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_seconds_floor_and_bad_input(spark):
    vals = ["1704067207179", "999", " 2000 ", "abc", None, "-1"]
    assert _one(spark, epoch_seconds("x"), vals) == [1704067207, 0, 2, None, None, -1]


def test_lookup_key(spark):
    df = spark.createDataFrame(
        [(" Jay Sean ", "Holding On"), ("Jay Sean", ""), ("", " Song "), ("", ""), (None, None)], "a string, s string"
    )
    got = [r[0] for r in df.select(lookup_key("a", "s")).collect()]
    assert got == ["jay sean holding on", "jay sean", "song", "", ""]


def test_functions_stay_in_codegen(spark):
    df = spark.range(3).select(F.col("id").cast("string").alias("x")).select(tokens("x"), extract_song_artist("x"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_hour_label_random_against_python(spark):
    import random
    import time

    rnd = random.Random(7)
    vals = [rnd.randint(-2208988800, 4102444799) for _ in range(500)]  # 1900 .. 2099
    want = [time.strftime("%d %b %Y-%H", time.gmtime(t)) for t in vals]
    assert _one(spark, hour_label("x"), vals, "x bigint") == want


def test_epoch_from_ntz_random_any_zone(spark):
    import datetime
    import random

    from songpulse.functions import epoch_ms_from_ntz, epoch_seconds_from_ntz

    rnd = random.Random(11)
    epoch = datetime.datetime(1970, 1, 1)
    stamps = [epoch + datetime.timedelta(microseconds=rnd.randint(0, 2_100_000_000_000_000)) for _ in range(300)]  # int seconds: up to 2036
    stamps += [datetime.datetime(2024, 3, 10, 2, 30, 0, 999), datetime.datetime(2024, 11, 3, 1, 30)]
    df = spark.createDataFrame([(s,) for s in stamps], "x timestamp_ntz")
    want = [((s - epoch) // datetime.timedelta(seconds=1), (s - epoch) // datetime.timedelta(milliseconds=1)) for s in stamps]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            got = [(r[0], r[1]) for r in df.select(epoch_seconds_from_ntz("x"), epoch_ms_from_ntz("x")).collect()]
            assert got == want, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
