"""Documents to training sequences: stages, each an operator of tabledocs.llm, applied one after another.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tabledocs.llm.decontamination import decontaminated
from tabledocs.llm.near_copies import NearCopyOptions, without_near_copies
from tabledocs.llm.packing import packed_tokens
from tabledocs.llm.quality import cleaned
from tabledocs.llm.secrets import without_secrets
from tabledocs.llm.shared import cut
from tabledocs.llm.token_counts import TokenOptions


#: The stage links from 0.8 on; a pair at 0.8 shares none of the 38 bands of 5 with a probability of 3e-7, and the longer signature errs there by five standard deviations for as few.
NEAR_COPIES = NearCopyOptions(percent=80, bands=38, slack=0.065)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without the lines that fail."""
    return cleaned(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by a similarity of 0.8 or more."""
    return without_near_copies(docs, NEAR_COPIES)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each with its place in a training sequence."""
    return packed_tokens(docs, TokenOptions(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", packing),
]

#: SQL has no form for groups of near copies and for packing
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is a table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
