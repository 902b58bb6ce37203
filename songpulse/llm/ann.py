"""Nearest neighbours by largest inner product, on low-dimensional stable projections.

Vectors get one more component so that all have the largest norm; then the largest inner product
is the least Euclidean distance d. They are projected to ``DIMS`` dimensions by independent
normal entries (2-stable), so a squared projected distance over d^2 is chi-square distributed.
A kd-tree over the projections yields a query's neighbours in order of projected distance; they
are verified on the original vectors until the next projected distance fails the test against
the k-th best distance d_k: projected^2 > quantile(DIMS, CONFIDENCE) * d_k^2. A neighbour at d_k
or nearer is beyond that point with probability 1 - CONFIDENCE at most.

On Spark the top of the tree is fitted on a bounded sample and deals every row to a cell; in
a cell the tree goes on to leaves. Queries search their nearest cell first, then the next 8, the
next 64 and the rest, in each round only cells that the test does not exclude by the distance found so far. Work comes in blocks of at most about
``CELL_ROWS`` rows and ``QUERY_ROWS`` queries: larger cells are split by a hash of the id. Queries
are routed by id, at most ``ROUTE_PAIRS`` pairs of query and cell at a time; their vectors are
joined after that.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite components take no
part, nor do NULL ids or vectors whose length is not the commonest one (the longer if tied);
equal scores are ordered by id; of rows that share an id the one of least vector counts, for queries too,
and no id is its own neighbour; finite components of any size are compared: where squares could leave the range of
doubles, vectors are multiplied by powers of two first and the scores back (they may become infinite or 0, and tie); fewer candidates than k are all returned; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songpulse.llm.common import one_per_id, stage

DIMS = 12  # even: the chi-square distribution then has a closed form
CONFIDENCE = 0.96
#: Rows that the cells are fitted on, on average, and the most cells.
SAMPLE_ROWS = 16_384
MOST_CELLS = 1 << 16
CELL_ROWS, QUERY_ROWS, LEAF_ROWS = 16_384, 4_096, 256
#: Pairs of a query and a cell that are compared, and sent on, at a time.
ROUTE_PAIRS = 1 << 20
#: Cells of a query, in order of distance, in the rounds before the last one, which takes the rest.
ROUND_CELLS = (1, 8, 64)
SEED = 20
#: Powers of two up to which components, and from whose reciprocal on, are used as they are.
SAFE_BITS = 200


def chi_square_cdf(x: float, dims: int) -> float:
    """P(chi-square of an even number of dimensions <= x)."""
    term, total = 1.0, 1.0
    for i in range(1, dims // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, dims: int) -> float:
    """The x at which the distribution reaches p."""
    low, high = 0.0, 1.0
    while chi_square_cdf(high, dims) < p:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dims) < p else (low, middle)
    return high


@dataclass(frozen=True)
class Index:
    """Projection (DIMS, length + 1), largest norm, and boxes (cells, DIMS) of the tree's top."""

    matrix: np.ndarray
    norm: float
    splits: tuple  # nested (dimension, value, below, above), or a cell's number
    low: np.ndarray
    high: np.ndarray
    stop: float

    def project(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of indexed vectors, with the added component."""
        rest = np.sqrt(np.maximum(0.0, self.norm**2 - (vectors**2).sum(1)))
        return vectors @ self.matrix[:, :-1].T + rest[:, None] * self.matrix[:, -1]

    def project_queries(self, vectors: np.ndarray) -> np.ndarray:
        """Projections of queries, scaled to the largest norm; their added component is 0."""
        return (vectors * (self.norm / np.linalg.norm(vectors, axis=1))[:, None]) @ self.matrix[:, :-1].T

    def cells(self, projected: np.ndarray) -> np.ndarray:
        """The cell of each projection."""
        out = np.zeros(len(projected), np.int64)

        def deal(node, rows: np.ndarray) -> None:
            if isinstance(node, tuple):
                above = projected[rows, node[0]] > node[1]
                deal(node[2], rows[~above])
                deal(node[3], rows[above])
            else:
                out[rows] = node

        deal(self.splits, np.arange(len(projected)))
        return out

    def radius(self, kth: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """Squared projected distance at which the test stops, from the k-th best inner products."""
        distance = 2 * self.norm**2 - 2 * kth * self.norm / np.linalg.norm(queries, axis=1)
        return np.where(np.isneginf(kth), np.inf, self.stop * np.maximum(distance, 0) + 1e-9 * self.norm**2)


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances (points, boxes)."""
    out = np.zeros((len(points), len(low)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        out += np.maximum(0, np.maximum(low[:, d] - x, x - high[:, d])) ** 2
    return out


def matrix_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.col("id").isNotNull() & fine)
    lengths = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return one_per_id(rows.where(F.size("v") == (lengths["n"] if lengths else 0)), "id", "ann-vectors")


def largest(v: str = "v") -> Column:
    """The largest magnitude of a vector's components."""
    return F.array_max(F.transform(v, lambda x: F.abs(x)))


def exponent(size: float) -> int:
    """Power of two to divide by: 0 if squares of the size are well inside the range of doubles."""
    return 0 if not size or 2.0**-SAFE_BITS <= size <= 2.0**SAFE_BITS else math.frexp(size)[1]


def times_power(x: Column, power: Column) -> Column:
    """x * 2^power, in two steps so that neither factor leaves the range of doubles."""
    half = F.floor(power / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), power - half)


def _top(points: np.ndarray, depth: int) -> tuple:
    """Splits of a sample to 2^depth cells and their boxes."""
    dims = points.shape[1]
    lows, highs = [], []

    def split(rows: np.ndarray, low: np.ndarray, high: np.ndarray, left: int):
        if not left or len(rows) < 2:
            lows.append(low)
            highs.append(high)
            return len(lows) - 1
        d = int(points[rows].std(0).argmax())
        value = float(np.median(points[rows, d]))
        below, above = high.copy(), low.copy()
        below[d] = above[d] = value
        over = points[rows, d] > value
        return d, value, split(rows[~over], low, below, left - 1), split(rows[over], above, high, left - 1)

    splits = split(np.arange(len(points)), np.full(dims, -np.inf), np.full(dims, np.inf), depth)
    return splits, np.array(lows), np.array(highs)


def fit(rows: DataFrame, dims: int = DIMS, confidence: float = CONFIDENCE, cell_rows: int = CELL_ROWS) -> Index | None:
    """An index of (id, v) rows; None if there are none. Only a bounded sample reaches the driver."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    facts = rows.agg(F.count("*").alias("n"), F.max(norm).alias("norm"), F.max(F.size("v")).alias("length")).first()
    if not facts["n"]:
        return None
    matrix = np.random.default_rng(SEED).standard_normal((dims, facts["length"] + 1))
    plain = Index(matrix, facts["norm"], 0, np.zeros((1, dims)), np.zeros((1, dims)), chi_square_quantile(confidence, dims))
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, SAMPLE_ROWS / facts["n"]) * (1 << 30))
    sample = rows.where(drawn).select("v").toArrow().column("v")
    wanted = min(MOST_CELLS, max(1, facts["n"] // cell_rows))
    splits, low, high = _top(plain.project(matrix_of(sample)), max(0, (wanted - 1).bit_length()) if len(sample) else 0)
    return Index(matrix, facts["norm"], splits, low, high, plain.stop)


def _leaves(points: np.ndarray) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: halves along the dimension of widest spread."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF_ROWS:
            leaves.append(rows)
            continue
        d = int(points[rows].std(0).argmax())
        middle = len(rows) // 2
        order = rows[np.argpartition(points[rows, d], middle)]
        todo += [order[:middle], order[middle:]]
    return leaves


def _distinct(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Rows without repeated ids, and of equal vectors those of the ``most`` smallest ids (no
    query can need more of them)."""
    _, first = np.unique(ids, return_index=True)
    _, group = np.unique(vectors[first], axis=0, return_inverse=True)
    order = np.lexsort((ids[first], group.ravel()))
    group = group.ravel()[order]
    begin = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
    place = np.arange(len(group)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(group)]])))
    return first[order[place < most]]


def search_block(
    index: Index, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, kth: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query number, id and score of the k best of each query in a block, and the pairs verified.

    ``kth``: a known lower bound of each query's k-th best inner product (-inf: none).
    """
    keep = _distinct(ids, vectors, k + 1)
    ids, vectors = ids[keep], vectors[keep]
    projected, wanted = index.project(vectors), index.project_queries(queries)
    leaves = _leaves(projected)
    low = np.array([projected[rows].min(0) for rows in leaves])
    high = np.array([projected[rows].max(0) for rows in leaves])
    away = box_distances(wanted, low, high)
    order = away.argsort(1, kind="stable")
    slack = 1e-9 * index.norm * np.linalg.norm(queries, axis=1)
    kth = kth.copy()
    best = np.full((len(queries), k), -np.inf)  # scores by matrix product, to bound the k-th best
    found_q, found_i, verified = [], [], 0
    radius = index.radius(kth, queries)
    for step in range(len(leaves)):
        leaf = order[:, step]
        open_ = np.flatnonzero(away[np.arange(len(queries)), leaf] <= radius)
        if not len(open_):
            break
        by_leaf = open_[np.argsort(leaf[open_], kind="stable")]
        for group in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            rows = leaves[leaf[group[0]]]
            a, b = wanted[group], projected[rows]
            gap = (a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T
            near = (gap <= radius[group][:, None] + 1e-6 * index.norm**2) & (ids[rows] != query_ids[group][:, None])
            verified += int(near.sum())
            scores = np.where(near, queries[group] @ vectors[rows].T, -np.inf)
            q, i = np.nonzero(near & (scores >= (kth - slack)[group][:, None]))
            found_q.append(group[q])
            found_i.append(rows[i])
            both = np.concatenate([best[group], scores], axis=1)
            best[group] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            kth[group] = np.maximum(kth[group], best[group].min(1))
        radius = index.radius(kth, queries)
    q, i = np.concatenate([np.zeros(0, np.int64), *found_q]), np.concatenate([np.zeros(0, np.int64), *found_i])
    # Exact scores, summed in one fixed order, for all that can still be among the k best.
    scores = np.concatenate([np.zeros(0), *((vectors[i[s : s + 4096]] * queries[q[s : s + 4096]]).sum(1) for s in range(0, len(q), 4096))])
    live = scores >= (kth - slack)[q]
    q, i, scores = q[live], i[live], scores[live]
    sorted_ = np.lexsort((ids[i], -scores, q))
    q, i, scores = q[sorted_], i[sorted_], scores[sorted_]
    begin = np.searchsorted(q, q)
    top = np.arange(len(q)) - begin < k
    return q[top], ids[i[top]], scores[top], verified


def _dealt(rows: DataFrame, index) -> DataFrame:
    """(id, v) rows with their cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = index.value.cells(index.value.project(matrix_of(batch.column(1)))) if len(batch) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], ["id", "v", "cell"])

    return rows.mapInArrow(run, "id long, v array<double>, cell long")


def _routes(
    batches: Iterator[pa.RecordBatch], index: Index, first: bool, places: tuple[int, int | None] = (1, None)
) -> Iterator[pa.RecordBatch]:
    """(id, kth, cell) of (id, v, kth) queries, in batches of at most ``ROUTE_PAIRS`` rows (or one query).

    ``places``: the first and the one after the last of a query's cells by distance, if not only the ``first``."""
    step = max(1, ROUTE_PAIRS // len(index.low))
    for whole in batches:
        for batch in (whole.slice(at, step) for at in range(0, len(whole), step)):
            vectors = matrix_of(batch.column(1))
            known = batch.column(2).to_numpy(zero_copy_only=False)
            kth = np.where(np.isnan(known.astype(float)), -np.inf, known)
            away = box_distances(index.project_queries(vectors), index.low, index.high)
            if first:
                q, cell = np.arange(len(batch)), away.argmin(1)
            else:
                due = np.zeros(away.shape, bool)
                np.put_along_axis(due, away.argsort(1, kind="stable")[:, slice(*places)], True, axis=1)
                q, cell = np.nonzero(due & (away <= index.radius(kth, vectors)[:, None]))
            columns = [batch.column(0).take(pa.array(q)), pa.array(kth[q]), pa.array(cell.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "kth", "cell"])


def _routed(queries: DataFrame, index, places: tuple[int, int]) -> DataFrame:
    """(id, kth, cell) of queries: the nearest cell, or those at later places that the test leaves."""
    return queries.mapInArrow(lambda batches: _routes(batches, index.value, not places[0], places), "id long, kth double, cell long")


def _rounds(n_cells: int) -> list[tuple[int, int]]:
    """The first and the one after the last place, by distance, of the cells of each round."""
    ends = [end for end in accumulate(ROUND_CELLS) if end < n_cells] + [n_cells]
    return list(zip([0, *ends[:-1]], ends, strict=True))


def _searched(cells: DataFrame, sizes: DataFrame, queries: DataFrame, routed: DataFrame, index, k: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each routed query in each block of its cells."""
    parts = routed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(QUERY_ROWS)).alias("n_q"))
    # One row per cell, MOST_CELLS at most.
    plan = F.broadcast(sizes.join(parts, "cell").select("cell", "n_sub", "n_q"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    data = cells.join(plan, "cell").select("id", "v", "cell", dealt("n_sub").alias("sub"), every("n_q").alias("part"))
    asked = routed.join(plan, "cell").join(queries.select("id", "v"), "id").select("id", "v", "kth", "cell", dealt("n_q").alias("part"), every("n_sub").alias("sub"))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(rows) or not len(queries):
            return schema.empty_table()
        query_ids = queries["id"].to_numpy()
        q, ids, scores, _ = search_block(
            index.value, rows["id"].to_numpy(), matrix_of(rows["v"]), query_ids, matrix_of(queries["v"]), queries["kth"].to_numpy(), k
        )
        return pa.table([query_ids[q], ids, scores], schema=schema)

    block = ["cell", "sub", "part"]
    return data.groupBy(*block).cogroup(asked.groupBy(*block)).applyInArrow(run, "query_id long, vec_id long, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k nearest rows found for each query."""
    spark = rows.sparkSession
    rows = usable(rows, id_col, vec_col)
    power = exponent(rows.agg(F.max(largest())).first()[0] or 0.0)
    if power:
        rows = rows.select("id", F.transform("v", lambda x: times_power(x, F.lit(-power))).alias("v"))
    index = fit(rows, cell_rows=cell_rows)
    if index is None or not index.norm:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shared = spark.sparkContext.broadcast(index)
    cells = stage(_dealt(rows, shared), "ann-cells")
    sizes = stage(cells.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(2 * cell_rows)).alias("n_sub")), "ann-sizes")
    asked = usable(queries, id_col, vec_col).where(F.size("v") == index.matrix.shape[1] - 1)
    safe = largest().between(2.0**-SAFE_BITS, 2.0**SAFE_BITS)
    own = F.when(safe, F.lit(0)).otherwise(F.floor(F.log2(largest())))
    asked = asked.withColumn("power", own.cast("long"))
    asked = stage(asked.withColumn("v", F.transform("v", lambda x: F.when(F.col("power") == 0, x).otherwise(times_power(x, -F.col("power"))))), "ann-queries")
    found = None
    for places in _rounds(len(index.low)):
        wanted = asked.select("id", "v", F.lit(None).cast("double").alias("kth"))
        if found is not None:
            kth = found.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
            wanted = wanted.drop("kth").join(kth, "id", "left")
        routed = stage(_routed(wanted, shared, places), "ann-routed")
        if found is not None and routed.isEmpty():  # then all cells farther off are excluded, too
            break
        more = _searched(cells, sizes, asked, routed, shared, k)
        found = stage(_best(more if found is None else found.drop("rank").unionByName(more), k), "ann-found")
    every = found.drop("rank")
    if power or not asked.where("power != 0").isEmpty():
        every = every.join(asked.select(F.col("id").alias("query_id"), "power"), "query_id")
        every = every.select("query_id", "vec_id", times_power(F.col("score"), F.col("power") + power).alias("score"))
    return _best(every, k).select("query_id", "rank", "vec_id", "score")
