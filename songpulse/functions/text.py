"""Text cleaning and (song, artist) extraction as native Spark column expressions.

Semantics follow a Python 2 program: ``str.strip()`` strips Unicode white space, ``\\S`` is the
ASCII complement of ``[ \\t\\n\\x0b\\f\\r]`` and ``re.IGNORECASE`` folds ASCII letters only.
Java regular expressions give the same answers once ``.`` is limited to "not a newline"
(flag ``d``, UNIX_LINES) and the white-space class is spelled out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the original program's behaviour) -------------------------------
# White space removed by Python 2.7 unicode.strip() (Unicode 5.2 tables, so U+180E counts):
# U+0009-U+000D, U+001C-U+001F, U+0020, U+0085, U+00A0, U+1680, U+180E, U+2000-U+200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
PY2_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u180e"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Characters deleted from a post after hashtags are removed: backslash, single quote,
# double quote, dollar, question mark, hyphen.
DELETED_CHARS = "\\'\"$?-"
# A run of non-blank characters (Python 2 ``\S`` without the UNICODE flag).
NON_BLANK_RUN = r"[^ \t\n\x0B\f\r]+"
# The (song, artist) extraction cascade, tried in this order; first pattern that matches wins.
# Case-insensitive, "." excludes only "\n". The original anchors with look-arounds; consuming
# the anchor text instead yields the same groups.
EXTRACTION_PATTERNS = (
    r"(?id)#nowplaying(.*.)by(.*?)from",
    r"(?id)#nowplaying(.*.)-(.*.)",
    r"(?id)#nowplaying(.*.)by(.*.)",
    r"(?idm)^(.*.)-(.*.)#nowplaying",
)
# The last pattern carries a line-start anchor (``m`` + ``^``; with ``d`` only "\n" ends a
# line). The unanchored form's leftmost match always starts at a line start, because any match
# starting inside a line also matches from that line's start, so the groups are identical; the
# anchor stops a backtracking engine from retrying every position of a post that does not
# match (cubic work). The SQL oracle keeps the unanchored form.
# ----------------------------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Remove leading and trailing Unicode white space (Python ``unicode.strip()``)."""
    return F.trim(_col(c), F.lit(PY2_WHITESPACE))


def tokens(c: Column | str) -> Column:
    """Clean a post: drop hashtags, the six special characters, URLs and mentions.

    Order matters and is kept: hashtags, special characters (NUL becomes ``000`` as the
    original escape-then-filter step does), strip, ``http...`` runs, ``@...`` runs, strip.
    Inner white space is not collapsed.
    """
    x = F.regexp_replace(_col(c), "#" + NON_BLANK_RUN, "")
    x = F.replace(x, F.lit("\x00"), F.lit("000"))
    x = F.translate(x, DELETED_CHARS, "")
    x = strip(x)
    x = F.regexp_replace(x, "http" + NON_BLANK_RUN, "")
    x = F.regexp_replace(x, "@" + NON_BLANK_RUN, "")
    return strip(x)


def _one_evaluation() -> str:
    """The whole cascade as one pattern over the whole text, with two groups per alternative.

    From the text's start each alternative skips as little as it can, so it finds the leftmost match of
    its pattern, as a search would, and a later alternative is tried only if no place fits an earlier
    one. The empty alternative makes it match every text.
    """
    tried = "|".join(f"(?s:.*?)(?:{pattern})" for pattern in EXTRACTION_PATTERNS)
    return rf"\A(?:{tried}|)(?s:.*)"


#: No group of the cascade can hold it: "." excludes it.
_BETWEEN = "\n"


def raw_groups(c: Column | str) -> Column:
    """``song`` + newline + ``artist``: the raw groups of the first pattern that matches (one regex
    evaluation); both empty if none does, or for NULL."""
    groups = range(1, 2 * len(EXTRACTION_PATTERNS) + 1)
    songs, artists = ("".join(f"${g}" for g in groups if g % 2 == odd) for odd in (1, 0))
    # A group of an alternative that was not taken is empty.
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), _one_evaluation(), songs + _BETWEEN + artists)


def cleaned_groups(raw: Column) -> Column:
    """Struct ``(song, artist)`` of ``raw_groups``, each cleaned by ``tokens``."""
    song, artist = F.substring_index(raw, _BETWEEN, 1), F.substring_index(raw, _BETWEEN, -1)
    return F.struct(tokens(song).alias("song"), tokens(artist).alias("artist"))


def extract_song_artist(c: Column | str) -> Column:
    """Struct ``(song, artist)`` from the first matching pattern, both cleaned by ``tokens``.

    No match (or NULL text) gives ``('', '')`` (``tokens('')`` is ``''``). The branch is chosen
    on *pattern matched*, not on a non-empty group, so an empty artist from the first pattern
    stays empty. The groups are bound once, as the variable of a one-element transform; over whole
    tables ``operators.clean.with_song_artist`` does the same in stages.
    """
    return F.get(F.transform(F.array(raw_groups(c)), cleaned_groups), F.lit(0))


def lookup_key(artist: Column | str, song: Column | str) -> Column:
    """Catalogue search text: ``lower(strip(artist) + ' ' + strip(song))``, stripped again.

    NULL sides count as empty; two empty sides give ``''`` (no request).
    """
    a = F.coalesce(strip(artist), F.lit(""))
    s = F.coalesce(strip(song), F.lit(""))
    return F.lower(strip(F.concat(a, F.lit(" "), s)))
