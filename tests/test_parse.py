"""JSON post lines: what is kept, what is dropped and why."""

from songpulse.sources.tweets import line_status, parse_tweets

LINES = [
    ('{"timestamp_ms":"1704067207179","text":"#nowplaying a by b"}', "ok", ("#nowplaying a by b", 1704067207)),
    ('{"timestamp_ms":1704067207999,"text":"n"}', "ok", ("n", 1704067207)),
    ('{"text":"x","timestamp_ms":"999","extra":{"k":[1]}}', "ok", ("x", 0)),
    ('{"limit":1}', "no_text", None),
    ('{"timestamp_ms":"1","text":null}', "no_text", None),
    ('{"timestamp_ms":"abc","text":"x"}', "bad_time", None),
    ('{"text":"x"}', "bad_time", None),
    ('{"timestamp_ms":9999999999999,"text":"a"}', "bad_time", None),
    ('{"timestamp_ms":"99999999999999999999","text":"a"}', "bad_time", None),
    ("", "blank", None),
    ("   ", "blank", None),
    ("not json", "not_json", None),
    ("[1,2]", "not_json", None),
    ("{'timestamp_ms':'1000','text':'x'}", "no_text", None),
    ('{"timestamp_ms":"1000","text":"a","text":"b"}', "ok", ("b", 1)),
    ('{"timestamp_ms":"1000","text":"a",}', "not_json", None),
]


def test_parse_and_status(spark):
    df = spark.createDataFrame([(l,) for l, _, _ in LINES], "value string")
    got = sorted(map(tuple, parse_tweets(df).collect()))
    assert got == sorted(w for _, _, w in LINES if w is not None)
    status = [r["status"] for r in line_status(df).collect()]
    assert status == [s for _, s, _ in LINES]
