"""Randomised posts: the Spark cascade against a plain scanner of the rules in SURVEY 2.6.1."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from songpulse.functions.text import PY2_WHITESPACE, extract_song_artist, tokens


def py_strip(s):
    return s.strip(PY2_WHITESPACE)


def py_tokens(s):
    s = re.sub(r"#[^ \t\n\x0b\f\r]+", "", s)
    s = s.replace("\x00", "000")
    s = "".join(c for c in s if c not in "\\'\"$?-")
    s = py_strip(s)
    s = re.sub(r"http[^ \t\n\x0b\f\r]+", "", s)
    s = re.sub(r"@[^ \t\n\x0b\f\r]+", "", s)
    return py_strip(s)


TAG, ASCII_LOWER = "#nowplaying", {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def last_before(line, mark, tail):
    """Place of the last ``mark`` behind one character that ``tail(place after it)`` accepts."""
    at = line.rfind(mark)
    while at >= 1 and not tail(at + len(mark)):
        at = line.rfind(mark, 0, at + len(mark) - 1)
    return at if at >= 1 else None


def parts_after_tag(text, mark, end):
    """First tag of a line whose rest splits at the last ``mark``; ``end`` gives where the artist
    ends, counted from where it starts (None: no match)."""
    for line in text.split("\n"):
        low, at = line.translate(ASCII_LOWER), -1
        while (at := low.find(TAG, at + 1)) >= 0:
            rest, low_rest = line[at + len(TAG) :], low[at + len(TAG) :]
            cut = last_before(low_rest, mark, lambda j: end(low_rest[j:]) is not None)
            if cut is not None:
                artist = rest[cut + len(mark) :]
                return rest[:cut], artist[: end(low_rest[cut + len(mark) :])]
    return None


def parts_before_tag(text):
    """Split of a line at the last hyphen that leaves an artist before the line's last tag."""
    for line in text.split("\n"):
        tag = line.translate(ASCII_LOWER).rfind(TAG)
        cut = line.rfind("-", 1, max(0, tag - 1)) if tag >= 0 else -1
        if cut >= 1:
            return line[:cut], line[cut + 1 : tag]
    return None


def py_extract(text):
    until_from = lambda x: x.find("from") if "from" in x else None
    rest = lambda x: len(x) or None
    found = (
        parts_after_tag(text, "by", until_from) or parts_after_tag(text, "-", rest)
        or parts_after_tag(text, "by", rest) or parts_before_tag(text) or ("", "")
    )
    return tuple(map(py_tokens, found))


WORDS = ["#nowplaying", "#NowPlaying", "by", "BY", "from", "-", " - ", "Baby", "song", "Artist", "@dj",
         "http://t.co/x", "#music", "don't", "$5", "\n", "\u2028", "\xa0", " ", "  ", "x", "fromage"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), min_size=1, max_size=12), min_size=20, max_size=40))
def test_cascade_matches_python(spark, posts):
    texts = [" ".join(p) for p in posts]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select(extract_song_artist("x").alias("e"), tokens("x").alias("t")).collect()
    for t, r in zip(texts, rows):
        assert (r["e"]["song"], r["e"]["artist"]) == py_extract(t), t
        assert r["t"] == py_tokens(t), t
