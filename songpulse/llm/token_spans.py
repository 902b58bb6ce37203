"""Token counts per section by offset-mapped attribution.

A document is encoded once, whole. Byte lengths of its tokens give their character spans (a
token of part of a character spans that character), which are interval-joined to the
document's sections by binary search on both sorted sides. A token inside one section counts
there. Rules for a token over a boundary: ``largest``, the section that holds most of its
characters, the earlier one if equal; ``first``, the section of its first character. So every
token counts once and the sections of a document add up to its token count.

Defined cases: a NULL or empty text has one empty section without tokens; sections are the lines,
each with its line feed, or come as a column of (start, end) that is sorted and does not
overlap (NULL: none); tokens outside all sections count in section -1, which is there only
then; repeated rows give equal rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from songpulse.llm.bpe import Codec, runs, share_ranks, worker_codec

RULES = ("largest", "first")
COLUMNS = ("section_no", "start", "end", "n_tokens", "n_crossing", "doc_tokens")


def token_chars(codec: Codec, lengths: np.ndarray, text: str, ids: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First character and end (exclusive) of each token."""
    ends = np.cumsum(lengths[np.frombuffer(ids, "<u4")])
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    raw = text.encode()
    if len(raw) == len(text):
        return starts, ends
    char = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
    return char[starts], char[ends - 1] + 1


def line_spans(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each line, its line feed included."""
    sizes = [len(x) + 1 for x in text.split("\n")]
    sizes[-1] -= 1
    if len(sizes) > 1 and not sizes[-1]:
        sizes.pop()  # the text ends with a line feed
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def allocate(
    tokens: tuple[np.ndarray, np.ndarray], sections: tuple[np.ndarray, np.ndarray], rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Section index of each token (-1: none) and whether the token reaches over its boundaries."""
    (s, e), (starts, ends) = tokens, sections
    first = np.searchsorted(ends, s, side="right")
    last = np.searchsorted(starts, e, side="left") - 1
    owner = np.where(first <= last, first, -1)
    inside = owner >= 0
    over = np.zeros(len(s), bool)
    over[inside] = (s[inside] < starts[owner[inside]]) | (e[inside] > ends[owner[inside]])
    if rule == "largest":
        for t in np.flatnonzero(first < last):
            touched = np.arange(first[t], last[t] + 1)
            shared = np.minimum(ends[touched], e[t]) - np.maximum(starts[touched], s[t])
            owner[t] = touched[shared.argmax()]
    elif rule == "first":
        gap = inside & (s < starts[np.maximum(owner, 0)]) if len(starts) else inside
        owner[gap], over[gap] = -1, False
    return owner, over


def section_counts(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", spans: str | None = None, rule: str = "largest"
) -> DataFrame:
    """``key``, section_no (from 0), start, end, n_tokens, n_crossing and doc_tokens; a row per section."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    shared = share_ranks(docs.sparkSession, ranks_path)
    given = F.col(spans).cast("array<struct<start:bigint,end:bigint>>") if spans else F.lit(None).cast("array<struct<start:bigint,end:bigint>>")
    rows = docs.select(key, given.alias("_spans"), F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = worker_codec(shared, pattern)
        lengths = np.zeros(max(codec.tokens) + 1, np.int64)
        for i, token in codec.tokens.items():
            lengths[i] = len(token)
        for batch in batches:
            for at, texts in runs(batch, 2):
                owners, columns = [], [[] for _ in COLUMNS]
                for i, (text, ids) in enumerate(zip(texts, codec.encode(texts), strict=True), at):
                    if spans:
                        pairs = batch.column(1)[i].as_py() or []
                        sections = tuple(np.array([p[k] for p in pairs], np.int64) for k in ("start", "end"))
                    else:
                        sections = line_spans(text)
                    owner, over = allocate(token_chars(codec, lengths, text, ids), sections, rule)
                    n = len(sections[0])
                    counts = np.bincount(owner + 1, minlength=n + 1)
                    crossing = np.bincount(owner[over] + 1, minlength=n + 1)
                    skip = 0 if counts[0] else 1
                    values = (
                        np.arange(skip - 1, n), np.concatenate([[0], sections[0]])[skip:], np.concatenate([[0], sections[1]])[skip:],
                        counts[skip:], crossing[skip:], np.full(n + 1 - skip, len(owner)),
                    )
                    owners.append(np.full(n + 1 - skip, i))
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                arrays = [pa.array(np.concatenate(c).astype(np.int64)) for c in columns]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(owners))), *arrays], [key, *COLUMNS])

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"`{c}` long" for c in COLUMNS))
