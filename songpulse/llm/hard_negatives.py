"""Hard negatives by a BOND vertical scan: exact score windows over dimensions stored as columns.

An anchor's positives are the rows of its label with the largest integer inner products; its hard negatives
for a positive are the best rows of other labels with a score between ``low`` and ``high`` per cent of
the positive's. Both are found by one scan: a block keeps its vectors by dimension; for each anchor the
dimensions are read in descending magnitude of its components, ``STEP`` at a time. After a step, what the
unread dimensions can still add lies between the sums of their smallest and largest contributions, so each row's score
has a lower and an upper bound. Rows that no longer can come among the k best, or into a
window, leave the candidate bitmap; when all dimensions are read the scores are exact and the windows are
resolved. A row that is sure to be in a window raises the window's floor for the others.

Vectors, blocks and rounds: see ``vector_blocks``. Blocks hold rows of equal label hashes, so the rows of
a label are in few blocks and a label of many rows in many. Defined cases beside those there: rows
with a NULL label take no part; an anchor without another row of its label has no positives and
so no result; equal scores are ordered by id; a positive with a negative score has no window; fewer
negatives than k are all returned; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from songpulse.llm import vector_blocks as B
from songpulse.llm.common import bounded, stage

#: Dimensions read between two looks at the bounds.
STEP = 16
LOW, HIGH = 80, 100
#: Blocks' buckets up to which their plan is broadcast (a few numbers each).
BROADCAST_BUCKETS = 100_000
POSITIVES = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("score", pa.int64())])
NEGATIVES = pa.schema([
    ("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()), ("negative_id", pa.int64()), ("score", pa.int64()),
])


class Columns:
    """Vectors by dimension, with the least and largest value of each; ``apart``: rows too long for doubles."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.apart = np.flatnonzero(B.lengths(vectors) >= B.LONG)
        plain = np.ones(len(vectors), bool)
        plain[self.apart] = False
        self.plain = np.flatnonzero(plain)
        self.columns = np.ascontiguousarray(vectors[self.plain].T.astype(np.float64))
        if len(self.plain):
            self.low, self.high = self.columns.min(1), self.columns.max(1)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, alive) -> tuple[np.ndarray, np.ndarray]:
        """Rows (numbers among ``rows``, a bitmap) and scores of those that stay ``alive``.

        ``alive(rows, lower, upper)`` says which of the rows with these bounds are still candidates.
        """
        all_apart = float(B.lengths(anchor[None])[0]) >= B.LONG
        apart = np.flatnonzero(rows) if all_apart else self.apart[rows[self.apart]]
        apart_scores = B.products(anchor[None], self.vectors[apart])[0] if len(apart) else np.zeros(0, np.int64)
        at = np.zeros(0, np.int64) if all_apart else np.flatnonzero(rows[self.plain])
        partial = np.zeros(len(at))
        if len(at):
            order = np.argsort(-np.abs(anchor), kind="stable")
            a = anchor[order].astype(np.float64)
            ends = np.sort([a * self.low[order], a * self.high[order]], axis=0)
            least, most = (np.append(np.cumsum(e[::-1])[::-1], 0.0) for e in ends)
            for begin in range(0, len(order), STEP):
                keep = alive(self.plain[at], partial + least[begin], partial + most[begin])
                if not keep.all():
                    at, partial = at[keep], partial[keep]
                if not len(at):
                    break
                dims = order[begin : begin + STEP]
                values = self.columns[dims] if len(at) == len(self.plain) else self.columns[np.ix_(dims, at)]
                partial = partial + a[begin : begin + STEP] @ values
        return np.append(self.plain[at], apart), np.append(np.rint(partial).astype(np.int64), apart_scores)


def _first(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by smaller id."""
    if len(scores) > k:
        top = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        return top[np.lexsort((ids[top], -scores[top]))][:k]
    return np.lexsort((ids, -scores))


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest value; -inf if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def _before(ids: np.ndarray, scores: np.ndarray, known: bool, kth: int, kth_id: int) -> np.ndarray:
    """Which come before the k-th best so far."""
    return (scores > kth) | (scores == kth) & (ids < kth_id) if known else np.ones(len(scores), bool)


def best_of(columns: Columns, ids: np.ndarray, rows: np.ndarray, anchor: np.ndarray, known: bool, kth: int, kth_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of an anchor's k best ``rows`` that come before its k-th best so far."""
    floor = float(kth) if known else -np.inf

    def alive(_, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        return upper >= max(floor, _kth(lower, k))

    found, scores = columns.scan(anchor, rows, alive)
    fine = _before(ids[found], scores, known, kth, kth_id)
    found, scores = found[fine], scores[fine]
    top = _first(ids[found], scores, k)
    return ids[found[top]], scores[top]


def windows_of(columns: Columns, ids: np.ndarray, rows: np.ndarray, anchor: np.ndarray, windows: list[dict], k: int, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window of an anchor, ids and scores of its k best ``rows`` that come before its k-th best so far.

    A window has ``score`` (the positive's) and ``known``, ``kth``, ``kth_id``.
    """
    # Whole numbers: the least and the largest score in the window.
    ends = [(-(-low * w["score"] // 100), high * w["score"] // 100) for w in windows]

    def alive(_, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(lower), bool)
        for w, (first, last) in zip(windows, ends, strict=True):
            if first > last:
                continue
            sure = lower[(lower >= first) & (upper <= last)]
            floor = max(float(first), float(w["kth"]) if w["known"] else -np.inf, _kth(sure, k))
            keep |= (upper >= floor) & (lower <= last)
        return keep

    found, scores = columns.scan(anchor, rows, alive)
    out = []
    for w, (first, last) in zip(windows, ends, strict=True):
        fine = np.flatnonzero((scores >= max(first, B.LEAST)) & (scores <= min(last, B.MOST)) & _before(ids[found], scores, w["known"], w["kth"], w["kth_id"])) if first <= last else np.zeros(0, np.int64)
        top = fine[_first(ids[found[fine]], scores[fine], k)]
        out.append((ids[found[top]], scores[top]))
    return out


def _positives(block: pa.Table, part: pa.Table, k: int) -> pa.Table:
    dims = block["dims"][0].as_py()
    ids, labels, vectors = block["id"].to_numpy(), block["label"].to_numpy(), B.matrix(block["v"], dims)
    anchors = B.matrix(part["v"], dims)
    asked = part.drop_columns(["v"]).to_pylist()
    out: list[list] = [[], [], []]
    order = sorted(range(len(asked)), key=lambda i: asked[i]["label"])
    held, label = None, None
    for i in order:
        q = asked[i]
        if held is None or q["label"] != label:
            label = q["label"]
            own = np.flatnonzero(labels == label)
            held = Columns(vectors[own]), ids[own]
        columns, own_ids = held
        found, scores = best_of(columns, own_ids, own_ids != q["id"], anchors[i], q["known"], q["kth"], q["kth_id"], k)
        out[0] += [q["id"]] * len(found)
        out[1] += found.tolist()
        out[2] += scores.tolist()
    return pa.table(out, schema=POSITIVES)


def _negatives(block: pa.Table, part: pa.Table, k: int, low: int, high: int) -> pa.Table:
    dims = block["dims"][0].as_py()
    ids, labels = block["id"].to_numpy(), block["label"].to_numpy()
    columns, anchors = Columns(B.matrix(block["v"], dims)), B.matrix(part["v"], dims)
    out: list[list] = [[], [], [], [], []]
    for anchor, q in zip(anchors, part.drop_columns(["v"]).to_pylist(), strict=True):
        found = windows_of(columns, ids, labels != q["label"], anchor, q["windows"], k, low, high)
        for w, (negatives, scores) in zip(q["windows"], found, strict=True):
            n = len(negatives)
            for column, values in zip(out, ([q["id"]] * n, [w["positive_id"]] * n, [w["score"]] * n, negatives.tolist(), scores.tolist()), strict=True):
                column += values
    return pa.table(out, schema=NEGATIVES)


def _best(found: DataFrame, by: list[str], id_col: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), id_col)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, low: int = LOW, high: int = HIGH,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", block_cells: int = B.BLOCK_CELLS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.

    ``anchors``: rows of the table that are anchors. ``low`` and ``high``: per cent of a
    positive's score between which its negatives score.
    """
    spark = rows.sparkSession
    taken = lambda df: B.integer_vectors(df.where(F.col(f"`{label_col}`").isNotNull()), id_col, vec_col, label_col).withColumnRenamed(label_col, "label").withColumn("label", F.col("label").cast("long"))
    rows, asked = taken(rows), taken(anchors)
    n_bucket = rows.groupBy("dims").agg(F.ceil(F.count("*") * F.greatest(F.col("dims"), F.lit(1)) / F.lit(block_cells)).alias("n_bucket"))
    n_bucket = stage(n_bucket, "bond-buckets")  # a row per vector length
    label_bucket = F.pmod(F.xxhash64("label"), F.col("n_bucket"))
    data, plan = B.in_blocks(rows.join(n_bucket, "dims"), label_bucket, {}, [F.asc("bucket")], block_cells)
    data = data.select("id", "v", "dims", "label", "place", "block")
    most_sub, n_blocks = plan.agg(F.max("n_sub"), F.max(F.col("first") + F.col("n_sub"))).first()
    asked = asked.join(F.broadcast(n_bucket), "dims").withColumn("bucket", label_bucket)
    kth = lambda: (F.col("kth_score").isNotNull().alias("known"), F.coalesce("kth_score", F.lit(0)).alias("kth"), F.coalesce("kth_id", F.lit(0)).alias("kth_id"))

    found = spark.createDataFrame([], "anchor_id long, positive_id long, score long, rank int")
    own = asked.join(bounded(plan, BROADCAST_BUCKETS), ["dims", "bucket"])
    for first, end in B.rounds(most_sub or 0):
        known = found.where(F.col("rank") == n_positives).select(F.col("anchor_id").alias("id"), F.col("score").alias("kth_score"), F.col("positive_id").alias("kth_id"))
        asks = own.join(known, "id", "left").select("id", "v", "dims", "label", *kth(), "first", "n_sub")
        asks = asks.withColumn("place", B.explode_range(F.lit(first), F.least("n_sub", F.lit(end)))).withColumn("block", F.col("first") + F.col("place"))
        asks = asks.drop("first", "n_sub", "place")
        new = B.met(data.where(F.col("place").between(first, end - 1)).drop("place"), asks, lambda b, p: _positives(b, p, n_positives), POSITIVES, block_cells)
        found = stage(_best(found.drop("rank").unionByName(new), ["anchor_id"], "positive_id", n_positives), "bond-positives")
    positives = found.select(F.col("anchor_id").alias("id"), "positive_id", F.col("score").alias("positive_score"))

    found = spark.createDataFrame([], "anchor_id long, positive_id long, positive_score long, negative_id long, score long, rank int")
    # One row per vector length.
    counts = F.broadcast(stage(plan.groupBy("dims").agg(F.max(F.col("first") + F.col("n_sub")).alias("n_block")), "bond-blocks"))
    for first, end in B.rounds(n_blocks or 0):
        known = found.where(F.col("rank") == n_negatives).select(F.col("anchor_id").alias("id"), "positive_id", F.col("score").alias("kth_score"), F.col("negative_id").alias("kth_id"))
        window = F.struct("positive_id", F.col("positive_score").alias("score"), *kth())
        windows = positives.join(known, ["id", "positive_id"], "left").groupBy("id").agg(F.sort_array(F.collect_list(window)).alias("windows"))
        asks = asked.join(windows, "id").join(counts, "dims")
        asks = asks.select("id", "v", "dims", "label", "windows", B.explode_range(F.lit(first), F.least("n_block", F.lit(end))).alias("block"))
        new = B.met(data.where(F.col("block").between(first, end - 1)).drop("place"), asks, lambda b, p: _negatives(b, p, n_negatives, low, high), NEGATIVES, block_cells)
        found = stage(_best(found.drop("rank").unionByName(new), ["anchor_id", "positive_id"], "negative_id", n_negatives), "bond-negatives")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", F.col("score").alias("negative_score"))
