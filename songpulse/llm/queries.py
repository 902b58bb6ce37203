"""Registered queries of the corpus operators: op<N>_<name>, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songpulse.llm import ann, bpe, chat, divergence, hard_negatives, html_text, lang_id, minhash, mixing, norm_search, pii, quality, token_spans
from songpulse.llm.common import table


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every vec_id divisible by 20, among all others."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where(F.col("vec_id") % 20 == 0), k=20)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a model that has not seen the held-out ones."""
    docs = table(spark, sf_dir, "documents")
    held = lang_id.held_out(F.col("doc_id"))
    model = lang_id.fit(docs.where(~held & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"))
    rows = lang_id.predict(docs, model)
    return rows.select("doc_id", held.alias("held_out"), "lang_pred", "score", "ambiguous")


def op3_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and one of control strings, read back from their formatted form."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    chats = chat.read_back(chat.format_chats(rows.unionByName(control)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(F.array_join("loss_texts", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("loss_texts", ""), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: token count and digests of ids and bytes."""
    rows = bpe.encode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN, decoded=True,
    )
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document, by four-word shingles."""
    rows = minhash.classes(table(spark, sf_dir, "documents"), shingle_words=4)
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; tokens over a boundary go where most of them is."""
    return token_spans.section_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_find_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts, digest of the base spans, all spans."""
    rows = pii.find(table(spark, sf_dir, "documents"))
    said = lambda found: F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    return rows.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in pii.BASE_KINDS),
        F.sha2(said(base), 256).alias("base_sha256"),
        said("pii").alias("spans"),
    )


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents mixed to the source weights: words taken of each."""
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


def op10_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule ledger of every document, with the verdict of the production policy."""
    rows = quality.apply_policy(quality.ledger(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fail_bits",
        (~quality.passes(quality.BASE)).alias("base_failed"), "kept",
    )


def op11_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products for every vec_id divisible by 50, among all others."""
    rows = table(spark, sf_dir, "embeddings")
    return norm_search.top_products(rows, rows.where(F.col("vec_id") % 50 == 0), k=5)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vec_id divisible by 100; vec_ids divisible by 7 change label first."""
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.mine(rows, rows.where(F.col("vec_id") % 100 == 0))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of every pair of a lang's sources, and each source's over-represented terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_language_id": op2_language_id,
    "op3_format_chats": op3_format_chats,
    "op4_bpe_round_trip": op4_bpe_round_trip,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_main_text": op7_main_text,
    "op8_find_pii": op8_find_pii,
    "op9_mix_sources": op9_mix_sources,
    "op10_quality_ledger": op10_quality_ledger,
    "op11_top_products": op11_top_products,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_divergence": op13_source_divergence,
}
