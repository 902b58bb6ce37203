"""Mixing sources to target weights by Efraimidis-Spirakis sampling (native).

Every document draws ``v = u^(1/w)``: ``u`` in (0, 1) is fixed by the doc_id and the seed, ``w``
in [1, 2] is its quality weight. Descending ``v`` is ascending exponential key ``-ln(u)/w``. A
source whose target is e full epochs and a rest takes every document e times, then the
documents of largest ``v`` up to the rest: the prefix sum of sizes in that order, to the
nearest whole document.

The prefix sum never sorts a whole source in one task: ``v`` is cut into buckets, sizes are
pre-aggregated per (source, bucket), and only the one bucket per source in which the budget
ends is sorted by document.

Defined cases: a NULL text has size 0 (and is taken 0 words, in ``MAX_EPOCHS`` copies at most); NULL is a source of its own, the
last; NULL doc_ids draw one fixed ``u``; equal ``v`` are ordered by doc_id, then size; repeated rows
count as documents of their own; an empty table gives an empty mix; further columns ride along
in ``mix`` and are ignored by ``plan``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from songpulse.llm.common import WORD_BREAK, bounded, n_chars, stage, whole_text, words

#: Source weights, dealt by code point order of the source and repeating.
WEIGHTS = (5, 2, 1)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: Documents per bucket, at most about twice as many; the number of buckets grows with the input.
BUCKET_DOCS = 10_000
#: Sources up to which the per-source plan (a few numbers each) is broadcast; else it is shuffled.
BROADCAST_SOURCES = 100_000


def draw(doc_id: Column, seed: str) -> Column:
    """Uniform in (0, 1) from 52 bits of an MD5 of doc_id and seed."""
    text = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}"))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def quality_weight(text: Column) -> Column:
    """1 + the share of the text's code points that are letters of any script."""
    letters = n_chars(F.regexp_replace(text, r"[\x00-\x40\x5B-\x60\x7B-\x7F]+", ""))
    return F.when(F.length(text) == 0, F.lit(1.0)).otherwise(F.lit(1.0) + letters / n_chars(text))


def sized(docs: DataFrame, keep: list[str], seed: str) -> DataFrame:
    """``keep`` columns, ``_id``, ``_src``, ``_size`` in words and ``_v``, the sampling order."""
    text = whole_text()
    rows = docs.select(
        *keep,
        F.col("doc_id").alias("_id"),
        F.col("source").alias("_src"),
        F.size(words(text)).cast("long").alias("_size"),
        draw(F.col("doc_id"), seed).alias("_u"),
        quality_weight(text).alias("_w"),
    )
    return rows.select(*keep, "_id", "_src", "_size", F.pow("_u", F.lit(1.0) / F.col("_w")).alias("_v"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = TOTAL_SHARE) -> DataFrame:
    """Rows (_src, source_size) with ``target``, ``epochs`` and the ``budget`` beyond the epochs.

    Water filling in closed form: in ascending order of cap per weight, a source is capped if its
    cap is at most its share of what the capped ones before it leave; all others get weight
    times one common level. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("_src").asc_nulls_last())
    everything = Window.partitionBy()
    n = len(weights)
    deal = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % n + 1)
    rows = sources.withColumn("_weight", deal.cast("long"))
    rows = rows.withColumns({
        "_cap": (F.col("source_size") * MAX_EPOCHS).cast("double"),
        "_all": F.sum("source_size").over(everything) * F.lit(share),
        "_weights": F.sum("_weight").over(everything),
    })
    filling = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("_src").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    rows = rows.withColumns({
        "_order": F.row_number().over(filling),
        "_level": (F.col("_all") - zero("_cap", before)) / (F.col("_weights") - zero("_weight", before)),
    })
    rows = rows.withColumn("_capped", F.col("_cap") <= F.col("_weight") * F.col("_level"))
    open_level = F.min(F.when(~F.col("_capped"), F.struct("_order", "_level"))).over(everything)["_level"]
    rows = rows.withColumn("target", F.when(F.col("_capped"), F.col("_cap")).otherwise(F.col("_weight") * open_level))
    epochs = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    rows = rows.withColumn("epochs", epochs.cast("long"))
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    return rows.select("_src", "source_size", "target", "epochs", budget.alias("budget"))


def mix(docs: DataFrame, keep: list[str] | None = None, seed: str = SEED, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """``keep`` (default doc_id), size, source_size, target, copies and taken; one row per document.

    ``copies`` is how often the mix takes the document, ``taken`` its words, repeats counted.
    """
    keep = keep or ["doc_id"]
    # Planning needs ids, sizes and draws only; other columns are read again when it is done.
    rows = stage(sized(docs, [], seed), "mix-sized")
    sources = stage(rows.groupBy("_src").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_n")), "mix-sources")
    largest = sources.agg(F.max("_n")).first()[0] or 1
    n_buckets = max(1, -(-largest // bucket_docs))
    bucket = F.floor((F.lit(1.0) - F.col("_v")) * n_buckets).cast("long")

    # Where the budget of each source ends: bucket sums, then running sums over the buckets.
    sums = rows.withColumn("_b", bucket).groupBy("_src", "_b").agg(F.sum("_size").alias("_sum"))
    run = Window.partitionBy("_src").orderBy("_b")
    sums = sums.withColumn("_end", F.sum("_sum").over(run))
    plan = targets(sources.select("_src", "source_size"))
    ends = (
        sums.alias("s").join(plan.alias("p"), F.col("s._src").eqNullSafe(F.col("p._src")))
        .where(F.col("s._end") > F.col("p.budget"))
        .groupBy("s._src")
        .agg(F.min(F.struct("s._b", (F.col("s._end") - F.col("s._sum")).alias("_before"))).alias("_cut"))
        .select(F.col("_src"), F.col("_cut._b").alias("_cut"), F.col("_cut._before").alias("_before"))
    )
    plan = plan.alias("p").join(ends.alias("e"), F.col("p._src").eqNullSafe(F.col("e._src")), "left").select(
        F.col("p._src").alias("_s2"), "source_size", "target", "epochs", "budget", "_cut", "_before"
    )
    plan = bounded(stage(plan, "mix-plan"), BROADCAST_SOURCES)
    rows = rows.withColumnRenamed("_id", "doc_id") if keep == ["doc_id"] else sized(docs, keep, seed)
    by_id = "doc_id" if keep == ["doc_id"] else "_id"
    rows = rows.withColumn("_b", bucket).join(plan, F.col("_src").eqNullSafe(F.col("_s2")))

    cols = [*keep, "_size", "source_size", "target", "epochs"]
    in_cut = F.coalesce(F.col("_b") == F.col("_cut"), F.lit(False))
    whole = rows.where(~in_cut).select(*cols, (F.col("_cut").isNull() | (F.col("_b") < F.col("_cut"))).alias("_in"))
    order = Window.partitionBy("_src").orderBy(F.desc("_v"), F.asc_nulls_last(by_id), "_size")
    ahead = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = rows.where(in_cut).withColumn("_at", F.col("_before") + ahead)
    cut = cut.select(*cols, (2 * F.col("_at") + F.col("_size") <= 2 * F.col("budget")).alias("_in"))
    out = whole.unionByName(cut).withColumn("copies", F.least(F.col("epochs") + F.col("_in").cast("long"), F.lit(MAX_EPOCHS)))
    return out.select(
        *keep,
        F.col("_size").alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        F.col("target").cast("double").alias("target"),
        "copies",
        (F.col("_size") * F.col("copies")).alias("taken"),
    )


def take(docs: DataFrame, seed: str = SEED, bucket_docs: int = BUCKET_DOCS) -> DataFrame:
    """The mixed documents with all columns of ``docs``: one row per copy that the mix takes.

    Rows ride along as one struct, so that no column name can clash. Only the documents of the
    buckets in which budgets end are shuffled with their texts.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    mixed = mix(docs.select(row, "doc_id", "source", "text"), ["_row"], seed, bucket_docs)
    return mixed.select("_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("_row.*")
