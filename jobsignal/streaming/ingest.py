"""Structured Streaming jobs: keyed ingest, extraction, replay removal, weekly counts.

Inputs are folders where files land. All jobs use ``availableNow``: they take what is
there, keep their position in the checkpoint and stop, so a scheduler can rerun them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobsignal.operators.merge import latest_per_key
from jobsignal.sources.store import Store


def read_landing(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _run(writer, checkpoint: str) -> None:
    stream = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        stream.awaitTermination()
    finally:
        stream.stop()


# Key ranges of a keyed state table; a batch rewrites those that its keys fall into.
STATE_BUCKETS = 64


def ingest(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: list[str], buckets: int = STATE_BUCKETS) -> None:
    """Merge each micro-batch into a table of the newest row per key, bucket by bucket.

    A batch reads the buckets of its own keys and writes them with dynamic partition overwrite; all other files stay,
    and a reader finds one row per key without merging. Rows may arrive late or again: the order value decides,
    so a batch that is replayed after a failure, also after some of its buckets were written, changes nothing.
    """
    def write(batch: DataFrame, _: int) -> None:
        spark, path = batch.sparkSession, f"{table}/rows"
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")
        rows = latest_per_key(batch, keys, order).select(*batch.columns, bucket).persist()
        try:
            touched = [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most ``buckets``
            if not touched:
                return
            known = _state(spark, table, rows.schema).where(F.col("_bucket").isin(touched))
            merged = latest_per_key(known.unionByName(rows), keys, order).select(*rows.columns)
            merged.hint("rebalance", "_bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path)
        finally:
            rows.unpersist()

    _run(stream.writeStream.foreachBatch(write), checkpoint)


def _state(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table}/rows")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{table}/rows")


def ingest_into_store(stream: DataFrame, store: Store, checkpoint: str, job: Callable[[Store, DataFrame], DataFrame]) -> None:
    """Run an ingestion job of the store on every micro-batch of landed rows.

    A batch is one committed run, so rows that arrive late are written late. One that is replayed after a failure
    merges the same keys with the same order, so the tables don't change.
    """
    def write(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            job(store, batch)

    _run(stream.writeStream.foreachBatch(write), checkpoint)


def ingested(spark: SparkSession, table: str, schema: StructType) -> DataFrame:
    """Keyed state over all batches, one row per key. Late rows are accepted: the order value decides, not the arrival."""
    return _state(spark, table, schema)


def extract(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], table: str, checkpoint: str) -> None:
    """Stateless extraction: the batch transform runs unchanged on the stream."""
    _run(transform(stream).writeStream.format("parquet").option("path", table).outputMode("append"), checkpoint)


def without_replays(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Drop repeated keys; a key is remembered for ``delay`` of event time."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.dropDuplicatesWithinWatermark(keys)


def window_counts(stream: DataFrame, by: str, time: str, width: str, delay: str) -> DataFrame:
    """Tumbling-window counts; a window is emitted once the watermark has passed it."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return timed.groupBy(F.window(time, width).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(
        F.col("w.start").alias("window_start"), by, "n")


def append(stream: DataFrame, table: str, checkpoint: str) -> None:
    _run(stream.writeStream.format("parquet").option("path", table).outputMode("append"), checkpoint)
