"""Corpus pipeline: from raw documents to token ids.

Each stage gets the documents that the one before it kept and decides about them with one of the operators; all but
the last return the columns of documents. Between stages the documents are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsignal.llm import byte_bpe, exact_dedup, mixing, near_dedup, quality_rules
from jobsignal.llm.common import staged, tokenizer_file
from jobsignal.session import configure


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, from sources that do."""
    configure(spark)
    return quality_rules.keep_good(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    configure(spark)
    return exact_dedup.keep_unique(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates the document with the smallest doc_id."""
    configure(spark)
    return near_dedup.keep_unique(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    configure(spark)
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each document of the mix."""
    configure(spark)
    return byte_bpe.round_trip(docs, tokenizer_file("byte_bpe_50k.tiktoken"))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix), ("byte-level BPE", encode)]

# Stages iterate and tokenize, which SQL does not express; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE = {"pipeline": (run, ORACLE_SQL)}
