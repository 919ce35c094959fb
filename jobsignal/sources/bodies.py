"""Long texts by content: each distinct one is stored once, under a 128-bit key.

Rows carry the key (16 bytes) instead of a page, a mail or a message text. Merges, joins and updates then move keys
only, whatever the texts weigh: resetting or restoring a page changes a key, and the texts themselves are only ever
appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def body_key(text: Column | str) -> Column:
    """Key of a text: its md5 as 16 bytes; null for null."""
    return F.unhex(F.md5(F.col(text) if isinstance(text, str) else text))


def keyed(df: DataFrame, **columns: str) -> DataFrame:
    """``df`` with each named text column replaced by the key column it is given: ``keyed(df, raw_html="page_key")``."""
    return df.select(*[body_key(c).alias(columns[c]) if c in columns else F.col(c) for c in df.columns])


def bodies_of(df: DataFrame, *columns: str) -> DataFrame:
    """body_key and body of the texts in ``columns``, each row's own; not yet distinct."""
    pairs = F.array(*(F.struct(body_key(c).alias("body_key"), F.col(c).alias("body")) for c in columns))
    return df.select(F.explode(pairs).alias("b")).select("b.*").where("body_key IS NOT NULL")


def new_bodies(stored: DataFrame, given: DataFrame) -> DataFrame:
    """Rows of ``given`` whose key is not stored, each once.

    Keys are settled first, on 16 bytes a row; ``given`` must be a written table with a unique column ``_place``.
    """
    firsts = given.groupBy("body_key").agg(F.min("_place").alias("_first"))
    wanted = firsts.join(stored.select("body_key"), "body_key", "left_anti").select("_first")
    return given.join(wanted, F.col("_place") == F.col("_first"), "left_semi").drop("_place")


def with_body(df: DataFrame, bodies: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` with the text of its ``key`` as ``name`` in the key's place."""
    texts = bodies.select(F.col("body_key").alias("_key"), F.col("body").alias(name))
    joined = df.join(texts, F.col(key) == F.col("_key"), "left")
    return joined.select(*[name if c == key else c for c in df.columns])
