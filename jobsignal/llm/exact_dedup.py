"""Exact duplicates of an incoming batch against an immutable snapshot, screened by binary fuse filters.

A snapshot is frozen once: its distinct digests are dealt over shards, and every shard gets one static binary
fuse filter (about nine bits a key). Incoming digests are grouped among themselves first, then screened by the
filter of their shard. Only positives are joined to the snapshot's exact buckets and compared byte by byte;
negatives never meet the snapshot.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal.llm.common import small, staged, text_of

# Keys per filter: bounds the memory of one build and of one screened group.
KEYS_PER_SHARD = 16_384

FILTER_SCHEMA = "shard long, seed long, segment_length int, segment_count int, fingerprints binary"


def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit finalizer over ``keys`` shifted by the seed."""
    x = keys + np.uint64(seed)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _slots(hashes: np.ndarray, segment_length: int, segment_count: int) -> np.ndarray:
    """Three slots of each hash, in three consecutive segments."""
    first = ((hashes >> np.uint64(32)) * np.uint64(segment_count * segment_length)) >> np.uint64(32)
    mask = np.uint64(segment_length - 1)
    second = (first + np.uint64(segment_length)) ^ ((hashes >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment_length)) ^ (hashes & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Seed, segment length, segment count and fingerprints of a filter that holds the distinct ``keys``.

    Keys are peeled in rounds: a slot that one remaining key uses belongs to that key. If a seed leaves keys
    unpeeled, the next one is tried.
    """
    keys = np.unique(keys.astype(np.uint64))
    n = max(len(keys), 2)
    length = min(1 << max(2, int(math.log(n) / math.log(3.33) + 2.25)), 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    count = max(1, -(-round(n * factor) // length) - 2)
    size = (count + 2) * length
    for seed in range(1, 1000):
        hashes = _mixed(keys, seed)
        slots = _slots(hashes, length, count)
        degree = np.bincount(slots.ravel(), minlength=size)
        owners = np.zeros(size, np.int64)  # xor of the ids of the keys left in a slot
        for row in slots:
            np.bitwise_xor.at(owners, row, np.arange(len(keys)))
        rounds, left = [], len(keys)
        frontier = np.flatnonzero(degree == 1)
        while len(frontier):
            peeled, at = np.unique(owners[frontier], return_index=True)
            rounds.append((peeled, frontier[at]))
            left -= len(peeled)
            touched = slots[:, peeled]
            for row in touched:
                np.subtract.at(degree, row, 1)
                np.bitwise_xor.at(owners, row, peeled)
            touched = np.unique(touched)
            frontier = touched[degree[touched] == 1]
        if left:
            continue
        prints = np.zeros(size, np.uint8)
        wanted = _fingerprint(hashes)
        for peeled, at in reversed(rounds):
            # the key's own slot is still zero, so the xor over its three slots is that of the other two
            others = np.bitwise_xor.reduce(prints[slots[:, peeled]], axis=0)
            prints[at] = wanted[peeled] ^ others
        return seed, length, count, prints.tobytes()
    raise ValueError("no seed peels the keys")


def may_hold(keys: np.ndarray, seed: int, length: int, count: int, prints: bytes) -> np.ndarray:
    """False only for keys that the filter does not hold; one in about 256 absent keys passes."""
    hashes = _mixed(keys.astype(np.uint64), seed)
    table = np.frombuffer(prints, np.uint8)
    return np.bitwise_xor.reduce(table[_slots(hashes, length, count)], axis=0) == _fingerprint(hashes)


def _build(group: pd.DataFrame) -> pd.DataFrame:
    built = build_filter(group["key"].to_numpy(np.int64).view(np.uint64))
    return pd.DataFrame([(int(group["shard"].iloc[0]), *built)],
                        columns=["shard", "seed", "segment_length", "segment_count", "fingerprints"])


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    if filters.empty or batch.empty:
        return batch[["digest"]].iloc[:0]
    f = filters.iloc[0]
    hit = may_hold(batch["key"].to_numpy(np.int64).view(np.uint64), int(f["seed"]), int(f["segment_length"]),
                   int(f["segment_count"]), f["fingerprints"])
    return batch.loc[hit, ["digest"]]


def _digest() -> Column:
    return F.unhex(F.sha2(text_of().cast("binary"), 256))


def classes(rows: DataFrame) -> DataFrame:
    """One row per digest: largest doc_id and number of rows; copies are summed before the shuffle."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("top"), F.count(F.lit(1)).alias("n"))


def _sharded(found: DataFrame, shards: int) -> DataFrame:
    key = F.xxhash64("digest")
    return found.select("digest", key.alias("key"), F.pmod(F.shiftright(key, 20), F.lit(shards)).alias("shard"))


def freeze(snapshot: DataFrame, shards: int) -> DataFrame:
    """Filters of a snapshot's classes, one row per shard that has keys; written once, never changed."""
    return staged(_sharded(snapshot, shards).groupBy("shard").applyInPandas(_build, FILTER_SCHEMA), "fuse-filters")


def exact_dedup(snapshot_docs: DataFrame, batch_docs: DataFrame, keys_per_shard: int = KEYS_PER_SHARD) -> DataFrame:
    """One row per row of both inputs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; a null text is the empty text. The row with the largest doc_id of a group
    stays. Rows that repeat a doc_id and its text stay or go together. A null doc_id is below all others: such a
    row stays only if no row of its group has an id (keep_id is then null). Other columns are ignored. Empty
    inputs give no rows.
    """
    spark = batch_docs.sparkSession
    docs = snapshot_docs.select("doc_id", "text", F.lit(True).alias("old")).unionByName(
        batch_docs.select("doc_id", "text", F.lit(False).alias("old")))
    rows = staged(docs.select("doc_id", "old", _digest().alias("digest")),
                  "digests")
    snapshot = staged(classes(rows.filter("old")), "snapshot-classes")
    batch = staged(classes(rows.filter("not old")), "batch-classes")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                 -(-max(snapshot.count(), batch.count()) // keys_per_shard))
    positives = (_sharded(batch, shards).groupBy("shard").cogroup(freeze(snapshot, shards).groupBy("shard"))
                 .applyInPandas(_screen, "digest binary"))
    met = staged(positives.join(batch, "digest").join(snapshot.withColumnsRenamed({"top": "old_top", "n": "old_n"}),
                                                      "digest"), "positives")
    wanted = small(met.select("digest", F.explode(F.array(
        F.struct(F.lit(False).alias("old"), F.col("top").alias("id")),
        F.struct(F.lit(True).alias("old"), F.col("old_top").alias("id")))).alias("r")).select("digest", "r.*"))
    texts = docs.select("doc_id", text_of().alias("text"), "old",
                        _digest().alias("digest")).alias("d").join(
        wanted.alias("w"), F.expr("d.digest = w.digest and d.old = w.old and d.doc_id <=> w.id"))
    same = texts.groupBy("d.digest").agg((F.min("text") == F.max("text")).alias("same")).filter("same")
    merged = met.join(same.select("digest"), "digest").select(
        "digest", F.greatest("top", "old_top").alias("all_top"), (F.col("n") + F.col("old_n")).alias("all_n"))
    found = (snapshot.withColumn("old", F.lit(True)).unionByName(batch.withColumn("old", F.lit(False)))
             .join(merged, "digest", "left")
             .select("digest", "old", F.when(F.col("all_n").isNull(), F.col("top")).otherwise(F.col("all_top")).alias("keep_id"),
                     F.coalesce("all_n", "n").alias("group_size")))
    return rows.join(found, ["digest", "old"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def split_dedup(docs: DataFrame) -> DataFrame:
    """Dedup of one table: half of it, chosen by a hash of the id, plays the frozen snapshot, the rest the batch."""
    old = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id"), F.lit(-1))), F.lit(2)) == 0
    return exact_dedup(docs.filter(old), docs.filter(~old))


def keep_unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, columns as they were. Only ids and digests are joined to them."""
    kept = staged(split_dedup(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.unhex("text_sha256").alias("_digest")).distinct(), "kept-digests")
    return docs.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (_digest() == F.col("_digest")), "left_semi")
