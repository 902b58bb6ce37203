"""Language identification by error-correcting output codes.

Every language has a codeword. Bit b's classifier is a binary naive Bayes model on hashed byte
n-grams of the lower-cased letters: the log-odds of an n-gram under the languages whose bit
is 1 against the others. A text's margin for a bit is the sum of its log-odds over the root of
its n-gram count (n-grams overlap). Decoding sums, over the bits, the logistic loss of the
margin against each codeword's bit, weighted by how far the bit's two sides are apart, and
takes the nearest codeword; ``ambiguous`` flags a text whose hard bits differ from it in more
places than the code corrects, or whose score is low.

The model is fitted on a bounded sample: about ``SAMPLE_DOCS`` whole documents of each language,
chosen by a hash of doc_id among the training rows; only n-gram counts reach the driver.

Defined cases: NULL text, or text without letters, is ``und`` with score 0; rows with NULL lang
never train; with no training rows all texts are ``und``, with one language all texts with
letters are that language, with score 1; ties go to the smaller language; texts are read whole
in pieces; repeated rows give equal rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Training documents of each language, on average (the bound of the sample).
SAMPLE_DOCS = 1500
SAMPLE_PARTITIONS = 16
ORDERS = (1, 2, 3, 4)
BUCKET_BITS = 16
SMOOTHING = 0.5
#: Bits per doubling of the number of languages in random codes, and codes that are tried.
CODE_RATE, CODE_TRIES = 15, 50
LOW_SCORE = 0.7
PIECE = 1 << 17
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters with single spaces around them; empty if there are none."""
    words = _OTHER.sub(" ", text.lower()).strip() if text else ""
    return f" {words} ".encode("utf-8", "replace") if any(map(str.isalpha, words)) else b""


def ngrams(raw: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the n-gram that begins at each byte, for one order after another."""
    acc = np.zeros(len(raw), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(raw) < n:
            return
        acc = acc[: len(raw) - n + 1] * np.uint32(0x01000193) + raw[n - 1 :] + np.uint32(n)
        if n in ORDERS:
            yield (acc * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)


def pieces(data: bytes) -> Iterator[np.ndarray]:
    """The bytes in pieces that overlap by the longest n-gram less one."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint32)
    for at in range(0, max(1, len(raw)), PIECE):
        yield raw[at : at + PIECE + max(ORDERS) - 1]


def codewords(n: int) -> np.ndarray:
    """Array (n, bits) of 0 and 1: all different two-class splits up to 7 classes, else the random
    code of largest least distance among CODE_TRIES."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= 7:
        columns = [c for c in product((0, 1), repeat=n) if c[0] == 1 and 0 in c]
        return np.array(columns, np.int8).T
    best, distance = None, -1
    for seed in range(CODE_TRIES):
        code = np.random.default_rng(seed).integers(0, 2, (n, CODE_RATE * int(np.ceil(np.log2(n)))), dtype=np.int8)
        apart = (code[:, None, :] != code[None, :, :]).sum(2) + np.eye(n, dtype=int) * code.shape[1]
        if apart.min() > distance:
            best, distance = code, apart.min()
    return best


@dataclass(frozen=True)
class Model:
    """Languages in order, their codewords, log-odds (bucket, bit) and bit weights."""

    langs: tuple[str, ...]
    code: np.ndarray
    odds: np.ndarray
    weights: np.ndarray

    def margins(self, data: bytes) -> np.ndarray:
        """One margin per bit; positive speaks for 1."""
        total, n = np.zeros(self.code.shape[1]), 0
        for raw in pieces(data):
            for grams in ngrams(raw):
                counted = grams[:PIECE]  # n-grams that begin in the overlap belong to the next piece
                total += self.odds[counted].sum(axis=0, dtype=np.float64)
                n += len(counted)
        return total / np.sqrt(max(1, n))

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1 and whether the decision is ambiguous."""
        data = letters(text)
        if not data or not self.langs:
            return "und", 0.0, False
        margin = np.clip(self.margins(data), -50, 50)
        sign = 2.0 * self.code - 1
        loss = (np.logaddexp(0, -sign * margin) * self.weights).sum(axis=1)
        best = int(loss.argmin())
        score = float(1 / np.exp(loss[best] - loss).sum())
        wrong = int(((margin > 0) != (self.code[best] == 1)).sum())
        least = min((int((a != b).sum()) for i, a in enumerate(self.code) for b in self.code[:i]), default=0)
        return self.langs[best], score, wrong > max(0, least - 1) // 2 or score < LOW_SCORE


def held_out(doc_id: Column) -> Column:
    """Whether CRC-32 of doc_id as text leaves 2 modulo 4 (NULL: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            count = counts.setdefault(lang.as_py(), np.zeros(1 << BUCKET_BITS))
            for raw in pieces(letters(text.as_py())):
                for grams in ngrams(raw):
                    count += np.bincount(grams[:PIECE], minlength=1 << BUCKET_BITS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(counts.keys(), pa.string()), pa.array((c.tobytes() for c in counts.values()), pa.binary())], ["lang", "counts"]
    )


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """A model of rows (doc_id, text, lang); those with NULL lang are left out."""
    rows = docs.where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = tuple(sorted(sizes))
    if not langs:
        return Model((), codewords(0), np.zeros((1 << BUCKET_BITS, 0), np.float32), np.zeros(0))
    share = F.element_at(F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, sample_docs / sizes[lang])))), F.col("lang"))
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20)) < share * (1 << 20)
    sample = rows.where(drawn).select(F.col("lang").cast("string"), F.col("text").cast("string")).repartition(SAMPLE_PARTITIONS)
    counts = {lang: np.zeros(1 << BUCKET_BITS) for lang in langs}
    for row in sample.mapInArrow(_count_batches, "lang string, counts binary").toLocalIterator():
        counts[row["lang"]] += np.frombuffer(row["counts"])
    # Every language counts alike, whatever the sample holds of it.
    p = np.array([counts[lang] / max(1.0, counts[lang].sum()) for lang in langs])
    smooth = SMOOTHING / max(1.0, min(counts[lang].sum() for lang in langs))
    code = codewords(len(langs))
    ones = np.stack([p[bit == 1].mean(axis=0) for bit in code.T], 1) + smooth if code.shape[1] else np.zeros((1 << BUCKET_BITS, 0))
    zeros = np.stack([p[bit == 0].mean(axis=0) for bit in code.T], 1) + smooth if code.shape[1] else ones
    odds = np.log(ones / zeros)
    apart = ((ones - zeros) * odds).sum(axis=0)
    return Model(langs, code, odds.astype(np.float32), apart / apart.mean() if len(apart) else apart)


def predict(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key``, lang_pred, score and ambiguous; one row per document, from its text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(key, F.col("text").cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(1)]
            lang, score, ambiguous = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
                [key, "lang_pred", "score", "ambiguous"],
            )

    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, ambiguous boolean")
