"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Only raw inputs are rendered before the clock starts, the way a real run finds its
input files; every query is then run once to completion without a sink. Extracted vacancies are written once per
application, so the first query that needs them pays for them. ``whole_run`` is all ingestion jobs one after the
other over an empty store: chat, mail, fetched pages, page parsing and the written report.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "extract_chat_vacancy", "extract_chat_statistic", "extract_mail_v0", "extract_mail_v1", "extract_web_page",
    "classify_chat", "salary_stats", "market_dynamics", "market_cube", "tech_demand", "eav_to_wide", "upsert_generic",
    "upsert_raw", "upsert_url_chat", "upsert_attr", "link_append", "apply_fetch", "restore_from_backup", "parse_due",
    "join_web_vacancy_raw", "latest_per_key", "fn_html_to_text", "fn_unwrap_tracking_url", "dom_select_css",
    "collect_distinct_join", "src_email_files", "stream_ingest", "stream_counts", "filter_vacancies", "top_k_stored", "openings_stored",
]


def whole_run(spark: SparkSession) -> None:
    """Raw chat messages, mails and pages to the report."""
    from jobsignal.plans import datasets, jobs
    from jobsignal.session import work_folder
    from jobsignal.sources.store import Store
    path = f"{work_folder(spark)}/bench-{time.time_ns()}"
    store = Store(spark, path)
    jobs.ingest_chat(store, datasets.chat(spark, SF_DIR))
    jobs.ingest_mail(store, datasets.mails(spark, SF_DIR).withColumn("text", F.lit("")))
    wanted = jobs.urls_to_fetch(store)
    log = datasets.pages(spark, SF_DIR).join(wanted, "url").select("url", F.lit(200).alias("status"), "html")
    jobs.ingest_fetches(store, log, datetime(2025, 6, 1, 12))
    jobs.parse_pages(store, datetime(2025, 6, 1, 13))
    jobs.report(store).write.parquet(f"{path}/report")


def main() -> None:
    from jobsignal.plans import datasets
    from jobsignal.plans.catalog import CATALOG
    from jobsignal.session import configure
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    for build in (datasets.chat, datasets.mails, datasets.pages, datasets.fetch_results, datasets.emls, datasets.links):
        build(spark, SF_DIR)
    seconds = {}
    for name in sys.argv[1:] or [*HEADLINE, "whole_run"]:
        start = time.time()
        if name == "whole_run":
            whole_run(spark)
        else:
            CATALOG[name][0](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
