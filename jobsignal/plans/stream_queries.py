"""Streaming jobs over landed files, checked on their final state."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from jobsignal.plans import datasets as T
from jobsignal.plans import expected as E
from jobsignal.plans.registry import registry
from jobsignal.session import work_folder
from jobsignal.sources import fixtures
from jobsignal.streaming import ingest as stream_jobs

QUERIES, query = registry()

_RUNS = itertools.count(1)


def _folders(spark, name: str) -> tuple[str, str]:
    """Fresh table and checkpoint folders of one run."""
    base = f"{work_folder(spark)}/streams/{name}-{next(_RUNS)}"
    return f"{base}/table", f"{base}/checkpoint"


def _landing(spark, sf_dir, name, build, files):
    df = fixtures.landed(spark, sf_dir, name, build, files)
    return df.schema, fixtures.landed_path(spark, sf_dir, name)


def _landing_in_order(spark, sf_dir, name, files):
    """Events as files that land one after the other, each with the next share of the time span."""
    base, events = f"{work_folder(spark)}/streams/{name}-{next(_RUNS)}", _events(spark, sf_dir)
    share = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - F.col("low")) * files / (F.col("high") - F.col("low") + 1))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    span = events.agg(F.min(micros).alias("low"), F.max(micros).alias("high")).first()
    placed = events.withColumns({"low": F.lit(span.low), "high": F.lit(span.high)}).withColumn("share", share)
    for i in range(files):
        placed.where(F.col("share") == i).select(*events.columns).coalesce(1).write.mode("append").parquet(base)
    return events.schema, base


def _events(spark, sf_dir):
    return T.table(spark, sf_dir, "events")


@query("stream_ingest", """
SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def stream_ingest(spark, sf_dir):
    """Several micro-batches merged into one keyed table."""
    schema, path = _landing(spark, sf_dir, "events_files", _events, 4)
    table, checkpoint = _folders(spark, "ingest")
    stream = stream_jobs.read_landing(spark, path, schema, files_per_batch=2)
    stream_jobs.ingest(stream, table, checkpoint, ["user_id"], ["ts", "event_id"])
    state = stream_jobs.ingested(spark, table, schema)
    return state.select("user_id", "event_id", "event_type", "value")


@query("stream_extract", E.with_(E.PARTS, E.CHAT) + "SELECT data_hash, position, company, experience, salary_from, url FROM chat")
def stream_extract(spark, sf_dir):
    """The batch extraction applied to a stream of chat files."""
    schema, path = _landing(spark, sf_dir, "chat_files", T.chat, 4)
    table, checkpoint = _folders(spark, "extract")
    stream = stream_jobs.read_landing(spark, path, schema, files_per_batch=2)
    stream_jobs.extract(stream, lambda df: T.extract_chat(T.classify.with_chat_type(df)).select(
        "data_hash", "position", "company", "experience", "salary_from", "url"), table, checkpoint)
    return spark.read.parquet(table)


@query("stream_dedup", "SELECT event_id, user_id, event_type, value FROM events")
def stream_dedup(spark, sf_dir):
    """Every event lands twice, in files that are read one by one, so the copies mostly meet in the kept state; each comes out once."""
    schema, path = _landing(spark, sf_dir, "events_twice", lambda s, d: _events(s, d).unionByName(_events(s, d)), 4)
    table, checkpoint = _folders(spark, "dedup")
    stream = stream_jobs.read_landing(spark, path, schema, files_per_batch=1)
    once = stream_jobs.without_replays(stream, ["event_id"], "ts", "40 days")
    stream_jobs.append(once.select("event_id", "user_id", "event_type", "value"), table, checkpoint)
    return spark.read.parquet(table)


@query("stream_counts", """
SELECT strftime(w, '%Y-%m-%d') AS window_start, event_type, count(*) AS n
FROM (SELECT time_bucket(INTERVAL 7 DAYS, ts, TIMESTAMP '1970-01-01') AS w, event_type FROM events)
WHERE w + INTERVAL 7 DAYS <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY GROUP BY ALL""")
def stream_counts(spark, sf_dir):
    """Weekly counts of the windows the watermark has closed; windows stay open over several micro-batches."""
    schema, path = _landing_in_order(spark, sf_dir, "events_in_order", 4)
    table, checkpoint = _folders(spark, "counts")
    stream = stream_jobs.read_landing(spark, path, schema, files_per_batch=1)
    stream_jobs.append(stream_jobs.window_counts(stream, "event_type", "ts", "7 days", "1 day"), table, checkpoint)
    return spark.read.parquet(table).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))
