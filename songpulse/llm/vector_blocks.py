"""Integer vectors in blocks, for exact searches of a query set against all rows.

Rows are dealt to buckets by a rule of the search (length, label), and buckets to blocks of about
``BLOCK_CELLS`` components, a bucket of many rows to many. Queries come in parts of about as
many components. A block and a part meet in one task, so no task holds more than both. Blocks are
searched in rounds, ``GROWTH`` times as many in each round as in all before it: what a query has found in the
earlier rounds bounds what a later block may send on, to about ``GROWTH`` times k rows a query
and round, however many blocks there are.

Components become floor(256 * x) as a long, or the nearest long; scores beyond +-(2^63 - 1) are the
nearest of these two. Vectors that are NULL or hold NULL or non-finite components take no part, nor do
NULL ids. A query meets rows of its own number of components. Of rows that share an id, the one
of least vector stands for all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songpulse.llm.common import one_per_id, stage

SCALE = 256
#: Components of a block of rows and of a part of queries.
BLOCK_CELLS = 1 << 18
GROWTH = 8
#: Length from which products are summed as Python integers: two shorter vectors' are exact as doubles.
LONG = float(1 << 26)
MOST = (1 << 63) - 1
LEAST = -MOST


def integer_vectors(rows: DataFrame, id_col: str, vec_col: str, *keep: str) -> DataFrame:
    """(id, v, dims, keep...) of the vectors that take part, one row per id."""
    x = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c * F.lit(float(SCALE))))
    kept = [F.col(f"`{c}`").alias(c) for c in keep]
    fine = rows.where(F.col(f"`{id_col}`").isNotNull() & x.isNotNull() & finite)
    out = fine.select(F.col(f"`{id_col}`").cast("long").alias("id"), scaled.alias("v"), *kept)
    return one_per_id(out.withColumn("dims", F.size("v")), "id", "vectors")


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Rows of a list column, all of ``dims`` integers."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def lengths(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(1))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products (rows of a, rows of b) as longs, within LEAST and MOST."""
    long_a, long_b = lengths(a) >= LONG, lengths(b) >= LONG
    out = np.rint(np.where(long_a[:, None], 0, a).astype(np.float64) @ np.where(long_b[:, None], 0, b).astype(np.float64).T).astype(np.int64)
    exact = lambda x, y: np.clip(x.astype(object) @ y.astype(object).T, LEAST, MOST).astype(np.int64)
    if long_a.any():
        out[long_a] = exact(a[long_a], b).reshape(int(long_a.sum()), len(b))
    if long_b.any():
        out[:, long_b] = exact(a, b[long_b]).reshape(len(a), int(long_b.sum()))
    return out


def in_blocks(
    rows: DataFrame, bucket: Column, facts: dict[str, Column], order: list[Column], block_cells: int = BLOCK_CELLS
) -> tuple[DataFrame, DataFrame]:
    """Rows with ``bucket``, ``place`` (the block's number in its bucket) and ``block``, and the plan.

    The plan has a row per dims and bucket: ``first``, ``n_sub`` (the bucket's blocks are first to first +
    n_sub - 1, counted per dims in ``order`` of buckets) and the ``facts`` aggregated over its rows.
    """
    rows = rows.withColumn("bucket", bucket)
    n_sub = F.ceil(F.count("*") * F.greatest(F.col("dims"), F.lit(1)) / F.lit(block_cells))
    plan = rows.groupBy("dims", "bucket").agg(n_sub.alias("n_sub"), *(c.alias(name) for name, c in facts.items()))
    ahead = Window.partitionBy("dims").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    plan = stage(plan.withColumn("first", F.coalesce(F.sum("n_sub").over(ahead), F.lit(0))), "blocks-plan")
    dealt = rows.join(plan.select("dims", "bucket", "first", "n_sub"), ["dims", "bucket"])
    dealt = dealt.withColumn("place", F.pmod(F.xxhash64("id"), F.col("n_sub"))).withColumn("block", F.col("first") + F.col("place"))
    return dealt.drop("first", "n_sub"), plan


def rounds(n: int, growth: int = GROWTH) -> Iterator[tuple[int, int]]:
    """[from, to) of the blocks of each round."""
    low, high = 0, 1
    while low < n:
        yield low, high
        low, high = high, high * growth


def explode_range(first: Column, end: Column) -> Column:
    """A row for each of first, first + 1, ... before ``end``; none if there is no such number."""
    return F.explode(F.when(first < end, F.sequence(first.cast("long"), end.cast("long") - 1)))


def met(data: DataFrame, asked: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: pa.Schema, part_cells: int = BLOCK_CELLS) -> DataFrame:
    """``run(rows of a block, part of its queries)`` for every block of ``data`` and each part of the
    queries in ``asked`` that name it; both have id, dims and block."""
    n_part = F.ceil(F.count("*") * F.greatest(F.col("dims"), F.lit(1)) / F.lit(part_cells))
    parts = asked.groupBy("dims", "block").agg(n_part.alias("n_part"))
    data = data.join(parts, ["dims", "block"]).withColumn("part", explode_range(F.lit(0), F.col("n_part"))).drop("n_part")
    asked = asked.join(parts, ["dims", "block"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("n_part"))).drop("n_part")

    def task(rows: pa.Table, queries: pa.Table) -> pa.Table:
        return run(rows, queries) if len(rows) and len(queries) else schema.empty_table()

    keys = ["dims", "block", "part"]
    ddl = ", ".join(f"{f.name} {'double' if pa.types.is_floating(f.type) else 'long'}" for f in schema)
    return data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(task, ddl)
