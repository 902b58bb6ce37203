"""Source divergence audit on a K-squared quadtree over the group-term count matrix.

Terms are the maximal runs of ASCII letters and characters beyond ASCII, A-Z in lower case. A lang
keeps the terms that at least ``MIN_DOCS`` of its documents hold. Its matrix has a row per (lang,
source) group and a column per kept term; most of it is zero. Each count has a smoothed price
p = 1 + floor(10^9 (count + 2) / (N + 2 V)), and a pair of groups diverges by the sum of
floor((p - q)^2 / (p + q)) over all columns.

The columns are dealt by a hash to blocks of about ``BLOCK_TERMS`` and the groups to tiles of
``TILE_GROUPS``, so that a task holds two tiles of one block. It builds the quadtree of its part:
a bit for every quadrant, level by level, set if the quadrant holds a count, children only of set quadrants (``K`` = 2).
The rows of two groups are followed down the tree together: where both quadrants are zero all their columns
have the same price, and the pair gets it once, times their number; only leaves that hold a count of
either are compared one by one. Block sums are added up per pair. A group's own leaves, priced against the lang's
row, give its over-represented terms; a block sends on the best ones (and their ties).

All arithmetic is exact: prices by long division, sums in 64-bit integers. Defined cases: NULL
text, lang and source are empty strings; a group without terms has zero counts; a lang without
kept terms has pairs of value 0 and no terms; texts of any length are read whole; repeated rows
count each time; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songpulse.llm.common import stage

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
BLOCK_TERMS, TILE_GROUPS = 1 << 13, 64
#: Bytes of text after which a task's counts are sent on, and bytes cut into terms at a time.
FLUSH_BYTES, PIECE_BYTES = 32 << 20, 4 << 20
#: Pairs of rows times quadrants that are followed at a time.
FRONTIER = 1 << 20

_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalpha() and b < 0x80 else 0x20 for b in range(256))
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in _TERM_BYTES)


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in pieces."""
    text = text.translate(_TERM_BYTES)
    at = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE_BYTES)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "term", "n", "docs"]
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            each = list(n.items())
            for at in range(0, len(each), 50_000):
                some = each[at : at + 50_000]
                found = [t for t, _ in some]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()), pa.array(found, pa.binary()),
                        pa.array([c for _, c in some], pa.int64()), pa.array([docs[t] for t in found], pa.int64()),
                    ],
                    names,
                )
        counts.clear()

    for batch in batches:
        for lang, source, text in zip(*batch.columns, strict=True):
            text = text.as_py()
            n, docs = counts.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            own: set[bytes] = set()
            for piece in terms(text):
                n.update(piece)
                own.update(piece)
            docs.update(own)
            held += len(text)
            if held >= FLUSH_BYTES:
                yield from sent()
                held = 0
    yield from sent()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term in a group, and its documents that hold it."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(empty("lang").alias("lang"), empty("source").alias("source"), empty("text").cast("binary").alias("text"))
    found = rows.mapInArrow(_count_batches, "lang string, source string, term binary, n long, docs long")
    return found.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def price(count: np.ndarray, total: np.ndarray | int, kept: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), by long division so that no product leaves 64 bits."""
    rest, below = np.asarray(count, np.int64) + 2, np.asarray(total, np.int64) + 2 * kept
    out = np.zeros(np.broadcast_shapes(rest.shape, below.shape), np.int64)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, below)
        out = out * 1000 + digit
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q))."""
    return (p - q) ** 2 // (p + q)


class Quadtree:
    """K-squared tree (K = 2) of a sparse matrix: bits of the quadrants, level by level, and leaf values.

    A set bit's number among the set bits of its level is its node on the next level, or its leaf.
    """

    def __init__(self, rows: np.ndarray, columns: np.ndarray, side: int):
        self.depth = max(1, (max(side, 1) - 1).bit_length())
        code = np.zeros(len(rows), np.int64)
        for bit in range(self.depth - 1, -1, -1):
            code = code << 2 | (rows >> bit & 1) << 1 | columns >> bit & 1
        self.order = np.argsort(code, kind="stable")  # of the cells, as leaves
        code = code[self.order]
        self.bits, self.rank = [], []
        nodes = np.zeros(1, np.int64)
        for level in range(1, self.depth + 1):
            quadrants = np.unique(code >> 2 * (self.depth - level))
            bits = np.zeros(4 * len(nodes), bool)
            bits[4 * np.searchsorted(nodes, quadrants >> 2) + (quadrants & 3)] = True
            self.bits.append(bits)
            self.rank.append(np.cumsum(bits) - 1)
            nodes = quadrants

    def child(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        """The node (or leaf) in a quadrant of each node; -1 if the quadrant, or the node, is zero."""
        at = 4 * np.maximum(node, 0) + quadrant
        return np.where((node >= 0) & self.bits[level][at], self.rank[level][at], -1)

    def walk(self, pairs: np.ndarray, n_columns: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Follows rows (a, b) of ``pairs`` (n, 2) down the tree together.

        Yields (pair, width, leaf a, leaf b): both leaves -1 for ``width`` columns that are zero in
        both rows, else one column with the leaves of the rows, -1 for a zero.
        """
        for begin in range(0, len(pairs), max(1, FRONTIER // max(1, n_columns))):
            some = pairs[begin : begin + max(1, FRONTIER // max(1, n_columns))]
            pair = np.arange(begin, begin + len(some))
            node = np.zeros((len(some), 2), np.int64) if len(self.order) else np.full((len(some), 2), -1)
            first = np.zeros(len(some), np.int64)  # column of the quadrant
            for level in range(self.depth):
                half = 1 << self.depth - level - 1
                row = pairs[pair] >> self.depth - level - 1 & 1
                below = []
                for right in (0, 1):
                    child = np.stack([self.child(level, node[:, i], 2 * row[:, i] + right) for i in (0, 1)], axis=1)
                    below.append((pair, child, first + half * right))
                pair, node, first = (np.concatenate(x) for x in zip(*below, strict=True))
                zero = (node < 0).all(1)
                width = np.clip(n_columns - first[zero], 0, half)
                yield pair[zero], width, node[zero, 0], node[zero, 1]
                pair, node, first = pair[~zero], node[~zero], first[~zero]
            yield pair, np.ones(len(pair), np.int64), node[:, 0], node[:, 1]


def pair_sums(rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, totals: np.ndarray, kept: int, n_columns: int, pairs: np.ndarray) -> np.ndarray:
    """Sum of gaps over ``n_columns`` for pairs of rows (an array (n, 2)) of a sparse matrix of counts.

    ``totals``: N of each row; ``kept``: V.
    """
    tree = Quadtree(rows, columns, max(n_columns, len(totals)))
    leaves = price(counts, totals[rows], kept)[tree.order] if len(rows) else np.zeros(1, np.int64)
    none = price(np.zeros(len(totals), np.int64), totals, kept)
    sums = np.zeros(len(pairs), np.int64)
    for pair, width, a, b in tree.walk(pairs, n_columns):
        p, q = (np.where(x >= 0, leaves[np.maximum(x, 0)], none[pairs[pair, i]]) for i, x in enumerate((a, b)))
        np.add.at(sums, pair, gap(p, q) * width)
    return sums


SUMS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("term_id", pa.int64()), ("value", pa.int64())])


def _block(cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Block sums of all pairs of two tiles' groups and, for a tile with itself, each group's best terms."""
    if not len(groups):
        return SUMS.empty_table()
    kept, n_columns = groups["kept"][0].as_py(), groups["n_terms"][0].as_py()
    tile_a, tile_b = groups["tile_a"][0].as_py(), groups["tile_b"][0].as_py()
    ids, totals, tiles = (groups[c].to_numpy() for c in ("group_id", "total", "tile"))
    order = np.argsort(ids)
    ids, totals, tiles = ids[order], totals[order], tiles[order]
    rows = np.searchsorted(ids, cells["row_id"].to_numpy())
    term_ids, columns = np.unique(cells["term_id"].to_numpy(), return_inverse=True)
    counts = cells["n"].to_numpy()
    a, b = np.flatnonzero(tiles == tile_a), np.flatnonzero(tiles == tile_b)
    pairs = np.stack([np.repeat(a, len(b)), np.tile(b, len(a))], axis=1)
    pairs = pairs[pairs[:, 0] < pairs[:, 1]] if tile_a == tile_b else pairs
    sums = pair_sums(rows, columns.ravel(), counts, totals, kept, n_columns, pairs)
    out = [pa.table([ids[pairs[:, 0]], ids[pairs[:, 1]], pa.nulls(len(pairs), pa.int64()), sums], schema=SUMS)]
    if tile_a == tile_b and len(rows):
        lang_total = groups["lang_total"][0].as_py()
        p, q = price(counts, totals[rows], kept), price(cells["lang_n"].to_numpy(), lang_total, kept)
        over = np.flatnonzero(p > q)
        over = over[np.lexsort((-gap(p, q)[over], rows[over]))]
        value = gap(p, q)[over]
        begin = np.searchsorted(rows[over], rows[over])
        last = np.minimum(begin + TOP_TERMS - 1, np.searchsorted(rows[over], rows[over], side="right") - 1)
        best = value >= value[last]  # ties with the last go along: the names decide
        over, value = over[best], value[best]
        out.append(pa.table([ids[rows[over]], pa.nulls(len(over), pa.int64()), term_ids[columns.ravel()[over]], value], schema=SUMS))
    return pa.concat_tables(out)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, block_terms: int = BLOCK_TERMS, tile_groups: int = TILE_GROUPS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank of every group."""
    counts = stage(term_counts(docs), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_docs")).where(F.col("_docs") >= min_docs).drop("_docs")
    # Numbers of terms and groups: any unique ones; the written tables fix them.
    kept = stage(kept.withColumn("term_id", F.monotonically_increasing_id()), "divergence-terms")
    per_lang = stage(kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total")), "divergence-langs")
    n_block = F.ceil(F.col("kept") / F.lit(block_terms))
    blocked = kept.join(per_lang.select("lang", n_block.alias("n_block")), "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("n_block"))).drop("n_block")
    cells = counts.select("lang", "source", "term", "n").join(blocked, ["lang", "term"]).drop("term")
    cells = stage(cells, "divergence-cells")

    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = docs.select(empty("lang").alias("lang"), empty("source").alias("source")).distinct()
    groups = stage(groups.join(totals, ["lang", "source"], "left").withColumn("group_id", F.monotonically_increasing_id()), "divergence-groups")
    groups = groups.join(per_lang, "lang", "left").select(
        "lang", "source", "group_id", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"),
        F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
    )
    n_tile = groups.groupBy("lang").agg(F.ceil(F.count("*") / F.lit(tile_groups)).alias("n_tile"))
    groups = groups.join(n_tile, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), F.col("n_tile")))
    groups = stage(groups, "divergence-tiles")

    def tiled(rows: DataFrame) -> DataFrame:
        """Rows of a tile once for each pair of tiles that it is in."""
        other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tile") - 1))
        rows = rows.withColumn("_other", other)
        return rows.withColumns({"tile_a": F.least("tile", "_other"), "tile_b": F.greatest("tile", "_other")}).drop("_other", "n_tile")

    block_sizes = blocked.groupBy("lang", "block").agg(F.count("*").alias("n_terms"))
    # New names on one side: both come from the table of groups.
    own = groups.select("lang", "source", F.col("group_id").alias("row_id"), F.col("tile").alias("_tile"), F.col("n_tile").alias("_n_tile"))
    left = tiled(cells.join(own, ["lang", "source"]).withColumnsRenamed({"_tile": "tile", "_n_tile": "n_tile"}))
    left = left.select("lang", "block", "tile_a", "tile_b", "row_id", "term_id", "n", "lang_n")
    right = tiled(groups.drop("source")).join(block_sizes, "lang")
    keys = ["lang", "block", "tile_a", "tile_b"]
    ddl = "a long, b long, term_id long, value long"
    found = stage(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_block, ddl), "divergence-sums")

    names = groups.select("group_id", "lang", "source")
    sums = found.where("b is not null").groupBy("a", "b").agg(F.sum("value").alias("value"))
    both = sums.unionByName(sums.select(F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    named = both.join(names.select(F.col("group_id").alias("a"), "lang", "source"), "a")
    named = named.join(names.select(F.col("group_id").alias("b"), F.col("source").alias("item")), "b")
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    # Langs without kept terms have no block.
    bare = groups.where("kept = 0").select("lang", "source")
    pairs = pairs.unionByName(
        bare.join(bare.select("lang", F.col("source").alias("item")), "lang").where("source != item")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    )
    best = found.where("term_id is not null").select(F.col("a").alias("group_id"), "term_id", "value")
    best = best.join(kept.select("term_id", F.col("term").alias("item")), "term_id").join(names, "group_id")
    best = best.select("lang", "source", F.lit("term").alias("part"), "item", "value")

    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = lambda rows: rows.withColumn("rank", F.row_number().over(order))
    return ranked(pairs).unionByName(ranked(best).where(F.col("rank") <= TOP_TERMS))
