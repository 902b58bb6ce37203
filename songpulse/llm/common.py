"""Helpers shared by the corpus operators: word expressions, tables, shared-folder stages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from songpulse.session import checkpoint_root

#: White space that separates words: U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables, read by Spark (the path may be in any Hadoop store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, with NULL read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than white space, in text order."""
    return F.array_remove(F.split(text, WORD_BREAK), "")


def has_word(text: Column) -> Column:
    """Whether the text holds a character other than white space."""
    return text.rlike(WORD_CHAR)


def without(text: Column, chars: str) -> Column:
    """The text without the given characters (byte searches, no regex)."""
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def n_chars(text: Column) -> Column:
    """Code points of the text."""
    return F.length(text).cast("long")


def n_of(text: Column, chars: str) -> Column:
    """Code points of the text that are in ``chars``."""
    return n_chars(text) - n_chars(without(text, chars))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage with files that outlive any executor, so a lost one costs only its tasks.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is.

    Call it on staged (cheap to count) tables of a few fixed-size columns, so that the row
    bound is a byte bound; beyond it Spark shuffles and AQE splits skewed join partitions.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


def one_per_id(rows: DataFrame, id_col: str, name: str) -> DataFrame:
    """Rows (staged as ``name``), one for each id: of several the least by the other columns in order.

    Only ids are counted; rows are compared only where an id is repeated.
    """
    rows = stage(rows, name)
    repeated = stage(rows.groupBy(id_col).count().where("count > 1").select(id_col), f"{name}-repeated")
    if repeated.isEmpty():
        return rows
    others = [c for c in rows.columns if c != id_col]
    least = rows.join(repeated, id_col, "left_semi").groupBy(id_col).agg(F.min(F.struct(*others)).alias("_r"))
    least = least.select(id_col, "_r.*").select(rows.columns)
    return stage(rows.join(repeated, id_col, "left_anti").unionByName(least), name)
