"""Helpers of the training-data operators: shared staging, size-checked broadcasts, row sources."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.session import work_folder

# A side is broadcast only after its rows were counted and found to be at most this many.
BROADCAST_ROWS = 100_000

# ASCII white space of the word rule [^\x20\x09-\x0D]+; also what bytes.split() splits at.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared work folder."""
    return f"{work_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the lineage, survives lost executors."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to have at most ``rows`` rows, else as it is (shuffled join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``df``, those with the smallest hashes of ``key``.

    About twice as many pass a threshold set from the count, so what is sorted doesn't grow with the table or its tasks.
    """
    span = 1 << 31
    place = F.pmod(F.xxhash64(key), F.lit(span))
    share = min(1.0, 2 * (rows + 50) / max(df.count(), 1))
    return df.filter(place <= int(span * share)).orderBy(place, key).limit(rows)


def text_of(name: str = "text") -> Column:
    """The text column as a string; null is the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def tokenizer_file(name: str) -> str:
    """Path of a public vocabulary, installed alike on every machine."""
    return public_tokenizers.path(name)
