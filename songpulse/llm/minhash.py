"""Near-duplicate classes by circulant MinHash, banding and exact Jaccard verification.

Signature: a first permutation places every shingle on the circle of 2^32 positions; coordinate
k is the minimum, over the shingles, of one second permutation read at the position shifted
by k steps around the circle. So two permutations give all coordinates. ``BANDS`` bands of
``ROWS`` coordinates are the look-up keys; a pair at the threshold shares none of them with
probability (1 - 0.8^5)^32 = 3e-6.

Copies (equal shingle sets) are first folded into one class, so that they cost one comparison
per class. Then, in three passes, never a group collected and no pair of an agreeing group
listed:

1. every class is paired with the least class that heads one of its buckets; the pairs are
   verified on the full sets and joined to components;
2. a class and the head of any of its buckets are a pair if their components still differ;
3. buckets that still hold different components list the pairs across components whose sizes and
   longer sketches (1,024 bits, made for these documents only) leave room for a link; a pair is
   listed in one of its common buckets, the one of least key, and verified too. A bucket is dealt
   to parts, and every two parts of it meet in a task of their own.

Pairs are thinned before the sets are fetched by set sizes and by a 128-bit sketch (one bit per
coordinate) whose bound a pair at the threshold misses with probability below 1e-7.

Defined cases: NULL text, empty text and text without words have an empty set and link with
nothing; fewer words than a shingle are one shingle; A-Z compare in lower case; rows that share
a doc_id are one document (if their texts differ, each is compared with other documents);
rows with a NULL doc_id are documents of their own, linked like others (inside they have numbers above all
doc_ids): their component_id is the smallest doc_id reached, or NULL if none is, and ``deduplicate`` keeps one row of
a class without doc_ids; an empty
table gives an empty result; further columns are ignored (``deduplicate`` keeps them).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from songpulse.llm import shingles as S
from songpulse.llm.common import bounded, stage
from songpulse.llm.components import components, forest_roots

THRESHOLD = 80  # per cent of Jaccard similarity
SHINGLE_WORDS = 5
BANDS, ROWS = 32, 5
SKETCH_BITS = 128
#: Differing sketch bits of a pair at 80 per cent: mean 12.8, deviation 3.4; P(more than 32) < 1e-7.
SKETCH_MOST = 32
#: Bits of the longer sketch: mean 102 differ at 80 per cent, deviation 9.6; P(more than 150) < 1e-6.
#: It counts coordinates from FINE_FROM on, which take no part in the bands.
FINE_BITS, FINE_MOST, FINE_FROM = 1024, 150, 1000
#: Ids up to which the table of needed documents (8 bytes a row) is broadcast; else it is shuffled.
BROADCAST_IDS = 1_000_000
#: Members of a bucket in one part; a task of the third pass compares two parts.
PART_ROWS = 512

_PLACE = np.uint64(0xA24BAED4963EE407)
_STEP = 0x9E3779B1  # odd, so the shifts run once around the circle
_P1, _P2 = 0x85EBCA6B, 0xC2B2AE35
_CHUNK = 16_384


def signature(sets: list[np.ndarray], n: int, first: int = 0) -> np.ndarray:
    """Array (n coordinates from ``first`` on, sets) of circulant MinHashes; no set may be empty."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    place = ((np.concatenate(sets) * _PLACE) >> np.uint64(32)).astype(np.uint32)
    spun = place * np.uint32(_P1)  # the shift distributes over the multiplication
    out = np.empty((n, len(sets)), np.uint32)
    v, t = np.empty_like(spun), np.empty_like(spun)
    for k in range(n):
        np.add(spun, np.uint32((first + k) * _STEP * _P1 & 0xFFFFFFFF), out=v)
        np.right_shift(v, 15, out=t)
        np.bitwise_xor(v, t, out=v)
        np.multiply(v, np.uint32(_P2), out=v)
        np.minimum.reduceat(v, starts, out=out[k])
    return out


def sketch(sig: np.ndarray) -> np.ndarray:
    """Array (words, sets) of 64-bit integers with one bit of every coordinate."""
    bits = np.packbits((sig >> np.uint32(16) & np.uint32(1)).astype(np.uint8), axis=0)
    return np.ascontiguousarray(bits.T).view(np.int64).T


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Array (sets, bands) of 64-bit keys, different for each band."""
    keys = np.empty((sig.shape[1], bands), np.uint64)
    for b in range(bands):
        acc = np.full(sig.shape[1], b + 1, np.uint64)
        for row in sig[b * rows : (b + 1) * rows]:
            acc = S.mix64(acc ^ row.astype(np.uint64)) + np.uint64(b)
        keys[:, b] = acc
    return keys.view(np.int64)


def _signature_batches(k: int, bands: int, rows: int):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
        ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            at = 0
            for group in S.grouped((S.shingle_set(t.as_py(), k) for t in texts), _CHUNK):
                full = [i for i, s in enumerate(group) if len(s)]
                n = np.array([len(s) for s in group], np.int64)
                digests = np.zeros((4, len(group)), np.int64)
                bands_of: list = [None] * len(group)
                if full:
                    sets = [group[i] for i in full]
                    sig = signature(sets, max(bands * rows, SKETCH_BITS))
                    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
                    every = np.concatenate(sets)
                    digests[0, full] = np.add.reduceat(S.mix64(every), starts).view(np.int64)
                    digests[1, full] = np.add.reduceat(S.mix64(~every), starts).view(np.int64)
                    digests[2:, full] = sketch(sig[:SKETCH_BITS])
                    for i, keys in zip(full, band_keys(sig, bands, rows), strict=True):
                        bands_of[i] = keys
                ids = batch.column(0).slice(at, len(group))
                at += len(group)
                arrays = [ids, pa.array(n), *map(pa.array, digests), pa.array(bands_of, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return run


def signatures(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """doc_id, set size ``n``, 128-bit set digest, sketch and band keys of every row."""
    schema = "doc_id long, n long, d1 long, d2 long, s1 long, s2 long, bands array<long>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _signature_batches(k, bands, rows), schema
    )


def _set_batches(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in S.grouped((S.shingle_set(t.as_py(), k) for t in batch.column(1)), 1 << 20):
                sets = pa.array([s.view(np.int64) for s in group], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), sets], ["id", "sh"])
                at += len(group)

    return run


def _fine_batches(k: int):
    names = ["id", *_FINE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in S.grouped((S.shingle_set(t.as_py(), k) for t in batch.column(1)), _CHUNK):
                words = np.zeros((len(_FINE), len(group)), np.int64)
                full = [i for i, s in enumerate(group) if len(s)]
                if full:
                    words[:, full] = sketch(signature([group[i] for i in full], FINE_BITS, FINE_FROM))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(group)), *map(pa.array, words)], names)
                at += len(group)

    return run


_SKETCH = ("s1", "s2")
_FINE = tuple(f"f{i}" for i in range(FINE_BITS // 64))


def _near(threshold: int, words: tuple[str, ...] = _SKETCH, most: int = SKETCH_MOST) -> Column:
    """Whether sizes and sketches (columns n and ``words`` with suffixes _a, _b) leave room for a
    link; the bounds on bits hold for 80 per cent and above."""
    n = [F.col("n_a"), F.col("n_b")]
    near = 100 * F.least(*n) >= threshold * F.greatest(*n)
    if threshold < THRESHOLD:
        return near
    bits = [F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in words]
    return near & (sum(bits[1:], bits[0]) <= most)


def _side(features: DataFrame, name: str, *more: str) -> DataFrame:
    """Features as one side of a pair: id as ``name``, n and the others with the suffix."""
    return features.select(F.col("id").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in ("n", *more)))


def _thinned(pairs: DataFrame, features: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) that sizes and sketches allow, with the sizes."""
    both = pairs.join(_side(features, "a", *_SKETCH), "a").join(_side(features, "b", *_SKETCH), "b")
    return both.where(_near(threshold)).select("a", "b", "n_a", "n_b")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of the documents in a staged table of ids."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string"))
    return texts.join(bounded(ids, BROADCAST_IDS), "id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """Pairs (a, b, n_a, n_b) whose full shingle sets reach the threshold, as links (a, b)."""
    ends = [pairs.select(F.col(side).alias("id")).distinct() for side in ("a", "b")]
    needed = stage(ends[0].union(ends[1]).distinct(), "minhash-needed")
    sets = stage(_texts(docs, needed).mapInArrow(_set_batches(k), "id long, sh array<long>"), "minhash-sets")
    x, y = sets.select(F.col("id").alias("a"), F.col("sh").alias("sa")), sets.select(F.col("id").alias("b"), F.col("sh").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    linked = 100 * common >= threshold * (F.size("sa") + F.size("sb") - common)  # of the texts that stand here
    return pairs.join(y, "b").join(x, "a").where(linked).select("a", "b")


def _relabelled(rows: DataFrame, maps: list[DataFrame], col: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the label of ``col`` through the label tables one after another."""
    rows = rows.withColumn(out, F.col(col))
    for found in maps:
        found = found.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
        rows = rows.join(found, F.col(out) == F.col("_id"), "left")
        rows = rows.withColumn(out, F.coalesce("_label", out)).drop("_id", "_label")
    return rows


def identified(docs: DataFrame, keep: list[str]) -> tuple[DataFrame, int | None]:
    """``keep`` columns and ``_iid``, a number for every document: its doc_id or, for rows without one, a number from the
    returned one on (None: there are no such rows). Those rows are staged, which fixes their numbers."""
    iid = F.col("doc_id").cast("long").alias("_iid")
    missing = docs.where(iid.isNull())
    if missing.isEmpty():
        return docs.select(*keep, iid), None
    first = (docs.agg(F.max(iid)).first()[0] or 0) + 1
    if first > 1 << 62:
        raise ValueError("doc_ids beyond 2^62 leave no numbers for documents without one")
    first = max(first, 0)
    numbered = missing.select(*keep, (F.lit(first) + F.monotonically_increasing_id()).alias("_iid"))
    return docs.where(iid.isNotNull()).select(*keep, iid).unionByName(stage(numbered, "minhash-unnamed")), first


def classes(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, threshold: int = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """doc_id, n_shingles and component_id; one row per input row.

    component_id is the smallest doc_id that links of at least ``threshold`` per cent reach.
    """
    docs, unnamed = identified(docs.select("doc_id", "text"), ["text"])
    found = _classes(docs.withColumnRenamed("_iid", "doc_id"), shingle_words, threshold, bands, rows)
    if unnamed is None:
        return found
    named = lambda c: F.when(F.col(c) < unnamed, F.col(c)).alias(c)
    return found.select(named("doc_id"), "n_shingles", named("component_id"))


def _classes(docs: DataFrame, shingle_words: int, threshold: int, bands: int, rows: int) -> DataFrame:
    """``classes`` of documents that all have a doc_id."""
    sig = stage(signatures(docs, shingle_words, bands, rows), "minhash-signatures")
    group = ["d1", "d2", "n"]
    # Copies have one signature, so any row of a class stands for it.
    reps = sig.where("n > 0").groupBy(*group).agg(
        F.min("doc_id").alias("id"), F.first("s1").alias("s1"), F.first("s2").alias("s2"), F.first("bands").alias("bands")
    )
    reps = stage(reps, "minhash-classes")
    keys = reps.select("id", F.explode("bands").alias("key"))
    heads = keys.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("size")).where("size > 1")
    others = stage(keys.join(heads, "key").where("id != head"), "minhash-members")
    features = reps.select("id", "n", "s1", "s2")

    def link(pairs: DataFrame) -> DataFrame:
        return verified(pairs, docs, shingle_words, threshold)

    # First pass: every class has one link at most, to a smaller id.
    pairs = stage(_thinned(others.groupBy(F.col("id").alias("b")).agg(F.min("head").alias("a")), features, threshold), "minhash-pairs")
    maps = [forest_roots(link(pairs).distinct())]

    # Second pass: a bucket's head and the members that are not in its component.
    apart = _relabelled(_relabelled(others, maps, "id", "label"), maps, "head", "head_label").where("label != head_label")
    apart = apart.select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    apart = stage(_thinned(apart, features, threshold), "minhash-pairs")
    if not apart.isEmpty():
        maps.append(_merged(link(apart), maps))

    # Third pass: pairs with a bucket's head have been tried, or are in one component.
    left = _relabelled(others.where("size > 2"), maps, "id", "label")
    mixed = left.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("key")
    left = stage(left.join(mixed, "key").select("key", "id", "label", "size"), "minhash-left")
    if left.isEmpty():
        return _classified(sig, reps, maps)
    needed = stage(left.select("id").distinct(), "minhash-needed")
    fine = _texts(docs, needed).mapInArrow(_fine_batches(shingle_words), ", ".join(["id long", *(f"{f} long" for f in _FINE)]))
    fine = stage(fine.join(reps.select("id", "n", "bands"), "id"), "minhash-fine")
    across = _thinned_across(left, fine, threshold)
    across = stage(across.select("a", "b").distinct(), "minhash-across")
    if not across.isEmpty():
        maps.append(_merged(link(across), maps))

    return _classified(sig, reps, maps)


def _thinned_across(left: DataFrame, fine: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of a bucket's members with different labels that sizes and longer sketches allow.

    A bucket's members are dealt by id to parts of about ``PART_ROWS``; every two parts meet in a cell of their own, so a
    hot bucket is compared in many tasks, and a member is copied once a part and once more."""
    parts = F.ceil(F.col("size") / PART_ROWS).cast("int")
    dealt = left.join(fine, "id").withColumn("part", F.pmod(F.xxhash64("id", "key"), parts).cast("int"))
    last = parts - 1
    x = dealt.withColumn("low", F.col("part")).withColumn("high", F.explode(F.sequence("part", last)))
    y = dealt.withColumn("high", F.col("part")).withColumn("low", F.explode(F.sequence(F.lit(0), "part")))
    cell = ["key", "low", "high"]
    x, y = (_side(rows, name, *cell, "label", "bands", *_FINE) for name, rows in (("a", x), ("b", y)))
    same_cell = (F.col("key_a") == F.col("key_b")) & (F.col("low_a") == F.col("low_b")) & (F.col("high_a") == F.col("high_b"))
    once = (F.col("low_a") < F.col("high_a")) | (F.col("a") < F.col("b"))
    least_common = F.array_min(F.array_intersect("bands_a", "bands_b")) == F.col("key_a")
    pair = same_cell & once & (F.col("label_a") != F.col("label_b"))
    return x.join(y, pair & _near(threshold, _FINE, FINE_MOST) & least_common).select("a", "b")


def _classified(sig: DataFrame, reps: DataFrame, maps: list[DataFrame]) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, by its class."""
    group = ["d1", "d2", "n"]
    found = _relabelled(reps.select(*group, "id"), maps, "id", "_component").drop("id")
    out = sig.drop("bands", "s1", "s2").join(found, group, "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("_component", "doc_id").alias("component_id"))


def _merged(links: DataFrame, maps: list[DataFrame]) -> DataFrame:
    """Label table that joins the components which ``links`` (a, b) connect."""
    ends = _relabelled(_relabelled(links, maps, "a", "la"), maps, "b", "lb")
    return components(ends.select(F.col("la").alias("a"), F.col("lb").alias("b")))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """The documents of smallest doc_id of their classes, once each, with all columns of ``docs``.

    Decisions are made on ids; the texts are shuffled only if the ids to drop are too many to
    broadcast.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")  # so that no column name can clash
    rows, _ = identified(docs.select(row, "doc_id", "text"), ["_row", "text"])
    options = {"shingle_words": SHINGLE_WORDS, "threshold": THRESHOLD, "bands": BANDS, "rows": ROWS} | options
    found = _classes(rows.select(F.col("_iid").alias("doc_id"), "text"), **options)
    found = stage(found.select(F.col("doc_id").alias("_id"), "component_id"), "minhash-found")
    gone = found.where("_id != component_id").select("_id").distinct()
    repeated = found.where("_id = component_id").groupBy("_id").count().where("count > 1").select("_id")
    repeated = stage(repeated, "minhash-repeated")
    out = stage(gone.unionByName(repeated), "minhash-gone")
    on = F.col("_iid") == F.col("_id")
    rows = rows.select("_row", "_iid")
    kept = rows.join(bounded(out, BROADCAST_IDS), on, "left_anti").select("_row.*")
    if repeated.isEmpty():
        return kept
    once = rows.join(bounded(repeated, BROADCAST_IDS), on, "left_semi").dropDuplicates(["_iid"])
    return kept.unionByName(once.select("_row.*"))
