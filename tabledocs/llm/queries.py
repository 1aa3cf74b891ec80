"""Registered queries of this subpackage, and SQL for the same results where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabledocs.llm.chat import format_chats, read_loss, read_turns
from tabledocs.llm.decontamination import contamination
from tabledocs.llm.divergence import source_divergence
from tabledocs.llm.embedding_copies import near_vectors
from tabledocs.llm.hard_negatives import hard_negatives, scored
from tabledocs.llm.licenses import license_notices
from tabledocs.llm.main_text import main_texts
from tabledocs.llm.near_copies import near_copies
from tabledocs.llm.oracle import CHAT, DIVERGENCE, HARD_NEGATIVES, QUALITY, SECRETS
from tabledocs.llm.packing import packed_tokens
from tabledocs.llm.quality import quality
from tabledocs.llm.secrets import BASE, secrets
from tabledocs.llm.token_counts import TokenOptions, token_counts
from tabledocs.llm.toxicity import toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document."""
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document; learns from labelled rows that are not held out."""
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every document."""
    return license_notices(_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts(_table(spark, sf_dir, "documents"), TokenOptions(public_tokenizers.path("word_bpe_49k.json")))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_texts(_table(spark, sf_dir, "pages"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one whose texts hold marks, read back from the formatted texts."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    chats = format_chats(turns.unionByName(tricky))
    read = chats.select(
        "conv_id", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.length("formatted").alias("chars")
    )
    texts = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(texts, 256).alias("turns_sha256"),
        F.length(F.array_join("loss", "")).cast("bigint").alias("loss_chars"), F.sha2(F.array_join("loss", ""), 256).alias("loss_sha256"),
        F.col("chars").cast("bigint").alias("formatted_chars"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training sequences of every document."""
    return packed_tokens(_table(spark, sf_dir, "documents"), TokenOptions(public_tokenizers.path("word_bpe_49k.json")))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality(_table(spark, sf_dir, "documents"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lines_removed", "chars_lost")
    return judged.select("doc_id", *[F.col(f"q_{x}").alias(x) for x in names])


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    found = secrets(_table(spark, sf_dir, "documents"))
    spans = F.col("secret_spans")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

    def listed(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter(spans, lambda s: s["kind"].isin([r.kind for r in BASE]))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"), listed(spans).alias("spans"),
    )


def op10_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_copies(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for the positives of every hundredth vector."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    points = _table(spark, sf_dir, "embeddings").select("vec_id", moved.alias("label"), scored(F.col("embedding")).alias("vector"))
    return hard_negatives(points, F.col("vec_id") % 100 == 0)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each source differs from the others of its language, and its most typical terms."""
    return source_divergence(_table(spark, sf_dir, "documents"))


def op13_embedding_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near-duplicate vectors."""
    return near_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_toxicity": op2_toxicity,
    "op3_license_scan": op3_license_scan,
    "op4_token_counts": op4_token_counts,
    "op5_main_text": op5_main_text,
    "op6_chat_format": op6_chat_format,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_quality_rules": op8_quality_rules,
    "op9_secret_scan": op9_secret_scan,
    "op10_near_copies": op10_near_copies,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_source_divergence": op12_source_divergence,
    "op13_embedding_copies": op13_embedding_copies,
}

#: the others need a tokenizer, a model, a search for bins, or components; they are tested against brute force
ORACLE: dict[str, str] = {
    "op6_chat_format": CHAT,
    "op8_quality_rules": QUALITY,
    "op9_secret_scan": SECRETS,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_source_divergence": DIVERGENCE,
}
