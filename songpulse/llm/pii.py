"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds the anchors: at-signs, plus signs, ``://``, a digit before
a dot, two digits of one chain, and words that announce a secret or an account. At each anchor a local
parser for its kind grows the span to both sides and validates it. The base kinds (email, ip,
card, phone) give exactly the leftmost non-overlapping matches of their patterns that pass
validation, a failed match is not tried again. Three more kinds are added: the user part of an
address with a scheme (``login``; the address itself is no personal data), the value after a
secret's cue (``secret``: after a password's any quoted one, one right behind a ``=``, or one that holds a
digit or a symbol of passwords and is no path, so that prose keeps its words; after the others one of 16 characters at
least) and the number after an account's cue (``account``). Cues count
in any case of their letters.

Defined cases: a NULL or empty text has no spans (``redact`` keeps NULL); texts of any length are
scanned whole; offsets are code points, end exclusive; repeated rows give equal rows; further
columns are ignored by ``find`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "login", "secret", "account")
#: Words that announce a secret or an account's number; lower case.
PASSWORD_CUES = ("password", "passwd", "passphrase", "pwd")
CUES = (*PASSWORD_CUES, "token", "secret", *(f"{a}{gap}key" for a in ("api", "access") for gap in ("", "_", "-", " ")))
ACCOUNT_CUES = ("iban", "kontonummer", "kundennummer") + tuple(
    f"{a}{gap}{n}" for a in ("account", "acct", "customer") for gap in ("", "_", "-", " ") for n in ("number", "no", "num", "nr", "id", "#")
)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_QUAD = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])+")
_CALL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOGIN = re.compile(r"[^\s/@:?#]+:[^\s/@?#]+(?=@)")
_VALUE = re.compile(r"[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_+/=.-]{16,})")
_PASSWORD = re.compile(
    r"[\"']?(?:[ \t]{0,3}[:=]{1,2}>?[ \t]{0,3}(?:\"((?:[^\"\\\n]|\\.)+)\"|'((?:[^'\\\n]|\\.)+)')|={1,2}>?[\"']?([^\s\"']\S*)"
    r"|[ \t]{0,3}[:=]{1,2}>?[ \t]{0,3}[\"']?(?![/~.]|[A-Za-z]+://)(?=\S*[0-9!@#$%^&*+=?|<>]\S)([^\s\"']\S*)"
    r"|[ \t]{0,3}[:=]{1,2}>?[ \t]{0,3}[\"']?(?![/~.]|[A-Za-z]+://)(?=\S*[0-9@#$%^&*+=|<>](?:\s|\Z))([^\s\"']\S*))"
)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])|[A-Za-z]{2}[0-9]{2}[A-Za-z0-9]{11,30}(?![A-Za-z0-9])")
_NUMBER = re.compile(r"[A-Za-z]{0,4}[-./ ]?[0-9](?:[-./ ]?[0-9]|[-./]?[A-Za-z](?![a-z])){3,33}")
_ANNOUNCES = re.compile(r"(?:[ _-]?(?:number|no|nr))?[\"'.]{0,2}\s{0,3}(?:[:=#]|is\b)?\s{0,3}[\"']?", re.I)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = frozenset("0123456789")


def _automaton() -> ahocorasick.Automaton:
    anchors = ahocorasick.Automaton()
    anchors.add_word("@", ("email", 1))
    anchors.add_word("+", ("phone", 1))
    anchors.add_word("://", ("login", 3))
    for d in "0123456789":
        anchors.add_word(f"{d}.", ("ip", 2))
        for e in "0123456789":
            for gap in ("", " ", "-"):
                anchors.add_word(d + gap + e, ("card", 2 + len(gap)))
    for cue in CUES:
        anchors.add_word(cue, ("secret", len(cue)))
    for cue in ACCOUNT_CUES:
        anchors.add_word(cue, ("account", len(cue)))
    anchors.make_automaton()
    return anchors


_ANCHORS = _automaton()


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _email(text: str, at: int, end: int, after: int) -> tuple[int, int, bool] | None:
    start = at
    while start > after and text[start - 1] in _LOCAL:
        start -= 1
    m = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, m.end(), True) if m else None


def _ip(text: str, at: int, end: int, after: int) -> tuple[int, int, bool] | None:
    start = end - 1
    while start > after and text[start - 1] in _DIGITS:
        start -= 1
    m = _QUAD.match(text, start) if start < end - 1 else None
    if not m:
        return None
    return start, m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))


def _card(text: str, at: int, end: int, after: int) -> tuple[int, int, bool] | None:
    if at < after:
        return None
    m = _CHAIN.match(text, at)
    digits = m.group().replace(" ", "").replace("-", "")
    return at, m.end(), 16 <= len(digits) <= 19 and _luhn(digits)


def _phone(text: str, at: int, end: int, after: int) -> tuple[int, int, bool] | None:
    m = _CALL.match(text, at) if at >= after else None
    return (at, m.end(), 8 <= sum(c in _DIGITS for c in m.group()) <= 15) if m else None


def _login(text: str, at: int, end: int, after: int) -> tuple[int, int, bool] | None:
    m = _LOGIN.match(text, end) if end >= after else None
    return (end, m.end(), True) if m else None


def _secret(text: str, at: int, end: int, after: int) -> tuple[int, int, bool] | None:
    if at < after:
        return None
    m = (_PASSWORD if text[at:end].lower() in PASSWORD_CUES else _VALUE).match(text, end)
    return (*m.span(m.lastindex), True) if m else None


def _account(text: str, at: int, end: int, after: int) -> tuple[int, int, bool] | None:
    if at < after or at and text[at - 1].isalnum():
        return None
    start = _ANNOUNCES.match(text, end).end()
    if text[end : end + 1].isalnum() and start == end:
        return None  # the cue is the beginning of a longer word
    if m := _IBAN.match(text, start):
        return start, start + _iban_length(m.group()), True
    m = _NUMBER.match(text, start)
    return (start, m.end(), True) if m else None


def _iban_length(found: str) -> int:
    """Characters of the shortest beginning whose check digits are right, else all."""
    for last in range(15, len(found) + 1):
        plain = found[:last].replace(" ", "").upper()
        if len(plain) >= 15 and found[last : last + 1] in ("", " ") and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
            return last
    return len(found)


_PARSERS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone, "login": _login, "secret": _secret, "account": _account}


def _lowered(text: str) -> str:
    """The text in lower case, character by character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(x := c.lower()) > 1 else x for c in text)


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in the order of KINDS, then by start."""
    found: dict[str, list[tuple[str, int, int]]] = {kind: [] for kind in KINDS}
    after = dict.fromkeys(KINDS, 0)
    for last, (kind, size) in _ANCHORS.iter(_lowered(text or "")):
        end = last + 1
        if end <= after[kind]:
            continue  # inside the last match of its kind
        match = _PARSERS[kind](text, end - size, end, after[kind])
        if match:
            start, after[kind], valid = match
            if valid:
                found[kind].append((kind, start, after[kind]))
    return [x for kind in KINDS for x in found[kind]]


def replaced(text: str, marks: dict[str, str]) -> str:
    """The text with every span replaced by its kind's mark; overlapping spans are one, of the first."""
    out, at = [], 0
    for kind, start, end in sorted(spans(text), key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], marks[kind]]
        at = max(at, end)
    return "".join([*out, text[at:]]) if out else text


def find(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key`` and ``pii``, an array of (kind, start, end, text); one row per document."""
    rows = docs.select(key, F.col("text").cast("string"))
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(1):
                text = value.as_py()
                found.append([(k, s, e, text[s:e]) for k, s, e in spans(text)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(item))], [key, "pii"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, pii array<struct<kind:string,start:int,end:int,text:string>>")


def redact(docs: DataFrame, marks: dict[str, str] | None = None) -> DataFrame:
    """The documents with personal data replaced by ``[KIND]``; n_chars, if there, follows the text."""
    marks = marks or {kind: f"[{kind.upper()}]" for kind in KINDS}
    at = docs.columns.index("text")
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if (t := v.as_py()) is None else replaced(t, marks) for v in batch.column(at)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(run, schema)
    if "n_chars" not in docs.columns:
        return out
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)).select(docs.columns)
