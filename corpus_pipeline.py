"""The corpus pipeline: quality rules, near-dedup, personal data, source mix, BPE round trip.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet in the shared checkpoint folder and reads it back as the next stage's documents. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songpulse.llm import bpe, minhash, mixing, pii, quality
from songpulse.llm.common import stage

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the production policy of the rule ledger."""
    return quality.select_passing(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of smallest doc_id, of every near-duplicate class (five-word shingles, 0.8)."""
    return minhash.deduplicate(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by marks; n_chars follows the text."""
    return pii.redact(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken (rows repeat over epochs)."""
    return mixing.take(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids (little-endian unsigned 32-bit) and text as decoded from the ids."""
    rows = bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=["doc_id", "source"], decoded=True)
    return rows.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.decode("decoded", "UTF-8").alias("text")
    )


STAGES = [
    ("quality_rules", quality_stage),
    ("minhash_dedup", dedup_stage),
    ("pii", pii_stage),
    ("mix_sources", mix_stage),
    ("bpe_round_trip", bpe_stage),
]

#: BPE has no SQL form; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
