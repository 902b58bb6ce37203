"""Exact top-k search by inner product: norm-bucketed retrieval.

Rows are grouped by length: a bucket holds lengths from ``RATIO`` times its grid point up to the next.
Buckets are searched from the longest down. For a query and a bucket the k-th best score found so
far, over the query's length times the bucket's longest, is the cosine that a row of it must reach:
above 1 the bucket is skipped; from ``COORDINATE_COSINE`` on, the query's ``FOCUS`` largest coordinates
bound those of a row, and sorted coordinates give the rows within the bounds; below it rows are
taken from the longest down to the length that can still reach the score. What is left is verified by its
exact integer product.

Vectors, blocks and rounds: see ``vector_blocks``. Defined cases beside those there: a vector of
zeros scores 0 with everything; equal scores are ordered by id; a query is not its own candidate;
fewer candidates than k are all returned; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songpulse.llm import vector_blocks as B
from songpulse.llm.common import bounded, stage

RATIO = 0.9
COORDINATE_COSINE = 0.8
FOCUS = 4
#: Products of a block and its queries made at a time.
TILE_CELLS = 1 << 20
#: Buckets of the length grid up to which their plan is broadcast (a few numbers each).
BROADCAST_BUCKETS = 100_000
_SLACK = 1e-9
SCHEMA = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def representatives(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Row numbers of the ``most`` smallest ids of each distinct vector: no query needs more of them."""
    if vectors.shape[1] == 0:
        return np.argsort(ids, kind="stable")[:most]
    _, group = np.unique(vectors, axis=0, return_inverse=True)
    order = np.lexsort((ids, group.ravel()))
    group = group.ravel()[order]
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    place = np.arange(len(group)) - np.repeat(begin, np.diff(np.append(begin, len(group))))
    return order[place < most]


class Bucket:
    """Rows of a block, longest first, with sorted coordinates of their directions (made when asked for)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        size = B.lengths(vectors)
        order = np.argsort(-size, kind="stable")
        self.ids, self.vectors, self.size = ids[order], vectors[order], size[order]
        self.directions = self.vectors / np.maximum(self.size, 1e-300)[:, None]
        self.sorted: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def by_length(self, least: float) -> int:
        """How many rows are at least so long."""
        return int(np.searchsorted(-self.size, -least * (1 - _SLACK), side="right"))

    def by_coordinates(self, direction: np.ndarray, cosine: float) -> np.ndarray:
        """Rows whose focus coordinates allow the cosine with a direction."""
        focus = np.argsort(-np.abs(direction), kind="stable")[:FOCUS]
        q = direction[focus]
        reach = np.sqrt(np.maximum(0, (1 - cosine**2) * (1 - q**2)))
        low, high = q * cosine - reach - _SLACK, np.where(q >= cosine, 1.0, q * cosine + reach) + _SLACK
        low = np.where(-q >= cosine, -1.0 - _SLACK, low)
        ranges = []
        for f, a, b in zip(focus.tolist(), low, high, strict=True):
            if f not in self.sorted:
                order = np.argsort(self.directions[:, f], kind="stable")
                self.sorted[f] = order, self.directions[order, f]
            order, values = self.sorted[f]
            ranges.append((np.searchsorted(values, a, side="left"), np.searchsorted(values, b, side="right"), order))
        begin, end, order = min(ranges, key=lambda r: r[1] - r[0])
        rows = order[begin:end]
        near = self.directions[rows][:, focus]
        return rows[((near >= low) & (near <= high)).all(1)]


def search_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, known: np.ndarray, kth: np.ndarray, kth_id: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, id and score of the k best rows of a block for each query, of those that
    come before its k-th best so far (score ``kth``, id ``kth_id``) if that is ``known``."""
    keep = representatives(ids, vectors, k + 1)
    bucket = Bucket(ids[keep], vectors[keep])
    size = B.lengths(queries)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    bound = np.where(known, kth.astype(np.float64), -np.inf)
    with np.errstate(divide="ignore", invalid="ignore"):
        cosine = np.where(bound > 0, bound / (size * bucket.size[0]), -np.inf)
        least = np.where(bound > 0, bound / size, 0.0)

    def verify(q: np.ndarray, rows: np.ndarray) -> None:
        scores = B.products(queries[q], bucket.vectors[rows])
        fine = bucket.ids[rows] != query_ids[q][:, None]
        limit = kth[q][:, None]
        fine &= ~known[q][:, None] | (scores > limit) | (scores == limit) & (bucket.ids[rows] < kth_id[q][:, None])
        if len(rows) > k:  # only what ties with the k-th best of these rows, or beats it
            floor = np.partition(np.where(fine, scores, B.LEAST), len(rows) - k, axis=1)[:, len(rows) - k]
            fine &= scores >= floor[:, None]
        i, j = np.nonzero(fine)
        order = np.lexsort((bucket.ids[rows[j]], -scores[i, j], i))
        i, j = i[order], j[order]
        top = np.arange(len(i)) - np.searchsorted(i, i) < k
        i, j = i[top], j[top]
        out.append((q[i], bucket.ids[rows[j]], scores[i, j]))

    focused = (cosine >= COORDINATE_COSINE) & (cosine <= 1 + _SLACK)
    for q in np.flatnonzero(focused):
        rows = bucket.by_coordinates(queries[q] / size[q], min(1.0, cosine[q] * (1 - _SLACK)))
        if len(rows):
            verify(np.array([q]), rows)
    by_length = np.flatnonzero(~(cosine >= COORDINATE_COSINE))
    by_length = by_length[np.argsort(-least[by_length], kind="stable")]
    step = max(1, TILE_CELLS // len(bucket.ids))
    for at in range(0, len(by_length), step):
        q = by_length[at : at + step]
        if n := bucket.by_length(float(least[q].min())):
            verify(q, np.arange(n))
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *column]) for column in zip(*out, strict=True)) if out else (none, none, none)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_products(
    rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block_cells: int = B.BLOCK_CELLS
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k rows of largest integer inner product with each query."""
    size = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    data = B.integer_vectors(rows, id_col, vec_col).withColumn("length", size)
    asked = B.integer_vectors(queries, id_col, vec_col).withColumn("length", size)
    bucket = F.when(F.col("length") >= 1, F.floor(F.log("length") / F.lit(-math.log(RATIO)))).otherwise(F.lit(-1))
    data, plan = B.in_blocks(data, bucket, {"longest": F.max("length")}, [F.desc("bucket")], block_cells)
    n_blocks = plan.agg(F.max(F.col("first") + F.col("n_sub"))).first()[0] or 0
    buckets = bounded(plan.select("dims", "first", "n_sub", "longest"), BROADCAST_BUCKETS)

    def run(block: pa.Table, part: pa.Table) -> pa.Table:
        dims = block["dims"][0].as_py()
        ids = part["id"].to_numpy()
        q, vec_ids, scores = search_block(
            block["id"].to_numpy(), B.matrix(block["v"], dims), ids, B.matrix(part["v"], dims),
            part["known"].to_numpy(zero_copy_only=False), part["kth"].to_numpy(), part["kth_id"].to_numpy(), k,
        )
        return pa.table([ids[q], vec_ids, scores], schema=SCHEMA)

    found = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long, rank int")
    for low, high in B.rounds(n_blocks):
        known = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
        open_ = asked.join(known, "id", "left").join(buckets, "dims")
        # A bucket's longest row bounds the scores in it; longs at the end of their range bound nothing.
        reach = F.col("length") * F.col("longest") * (1 + 2 * _SLACK)
        open_ = open_.where(F.col("kth_score").isNull() | (F.col("kth_score") <= 0) | (reach >= F.col("kth_score")))
        block = B.explode_range(F.greatest("first", F.lit(low)), F.least(F.col("first") + F.col("n_sub"), F.lit(high)))
        open_ = open_.select(
            "id", "v", "dims", F.col("kth_score").isNotNull().alias("known"), F.coalesce("kth_score", F.lit(0)).alias("kth"),
            F.coalesce("kth_id", F.lit(0)).alias("kth_id"), block.alias("block"),
        )
        new = B.met(data.where(F.col("block").between(low, high - 1)).select("id", "v", "dims", "block"), open_, run, SCHEMA, block_cells)
        found = stage(_best(found.drop("rank").unionByName(new), k), "norm-search")
    return found.select("query_id", "rank", "vec_id", "score")
