"""Fetch log handling: candidates, blocked answers, due pages, write-backs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal.functions import scalars as X
from jobsignal.operators.merge import latest_per_key, upsert


def fetch_rows(log: DataFrame) -> DataFrame:
    """Landed log rows in one shape: failed transports are status 0 with the error
    text, other answers than 200 keep their status and get an error text, 200 is trimmed."""
    failed = F.coalesce(F.col("html"), F.lit(D.FETCH_FAILED))
    refused = F.concat(F.lit(D.FETCH_REFUSED[0]), F.col("url"), F.lit(D.FETCH_REFUSED[1]), F.col("status").cast("string"))
    status = F.coalesce(F.col("status"), F.lit(0))
    html = F.when(status == 0, failed).when(status != 200, refused).otherwise(X.strip(F.col("html")))
    return log.withColumn("html", html).withColumn("status", status)


def is_blocked(html: Column) -> Column:
    result = F.lit(True)
    for mark in D.BLOCKED_MARKS:
        result = result & F.contains(html, F.lit(mark))
    return F.coalesce(result, F.lit(False))


def detect_blocked(results: DataFrame) -> DataFrame:
    """A page that says the address was blocked counts as status 429."""
    return results.withColumn("status", F.when(is_blocked(F.col("html")), 429).otherwise(F.col("status")))


def refetch_candidates(urls: DataFrame) -> DataFrame:
    """Urls never fetched or last answered with anything but 200 and 404."""
    return urls.where(F.col("page_key").isNull() | ~F.col("status_code").isin(404, 200)).select("url")


def apply_fetch(urls: DataFrame, results: DataFrame, order: list[str]) -> DataFrame:
    """Write fetch results to the url table and mark the pages as unparsed.

    ``results`` carries ``url, page_key, status_code, last_check``; the result adds ``outcome``.
    """
    batch = results.withColumn("parsing_date", F.lit(None).cast("timestamp_ntz"))
    return upsert(urls, batch, ["url"], ["page_key", "status_code", "last_check", "parsing_date"], order)


def join_web_vacancy_raw(urls: DataFrame, vacancies: DataFrame, raw: DataFrame) -> DataFrame:
    """Pages with their vacancy and raw message. Keys are unique on the right sides."""
    return urls.join(vacancies, "data_hash").join(raw, "raw_key")


def parse_due(joined: DataFrame, from_date: datetime | None = None) -> DataFrame:
    """Fetched pages that were never parsed, changed since, or belong to a message
    on or after ``from_date``; without a date the last arm is off."""
    due = F.col("parsing_date").isNull() | (F.col("parsing_date") < F.col("last_check"))
    if from_date is not None:
        due = due | (F.col("date") >= F.lit(from_date).cast("timestamp_ntz"))
    return joined.where((F.col("status_code") == 200) & due)


def reset_known_urls(urls: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Mail rule: a url seen again loses its page, so that it is fetched once more."""
    return upsert(urls, batch, ["url"], ["data_hash"], order,
                  on_match={"page_key": F.lit(None).cast("binary"), "status_code": F.lit(None).cast("int")})


def point_urls(urls: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Chat rule: a known url keeps its page, only the vacancy pointer moves."""
    return upsert(urls, batch, ["url"], ["data_hash"], order)


def apply_web_parse(urls: DataFrame, parsed: DataFrame, run_ts: datetime) -> DataFrame:
    """Canonical url and parsing time on the rows whose page was parsed; one row per url.

    A page without canonical link keeps its url. Where the page's own url has a row already, or several pages name one
    url, the row last parsed stays, then the one last checked. Only urls that some page named are looked at for that.
    """
    done = parsed.groupBy("page_url").agg(F.max("url").alias("_canonical"))
    written = urls.join(done, F.col("url") == F.col("page_url"), "left")
    value = {"url": F.coalesce("_canonical", "url"),
             "parsing_date": F.when(F.col("page_url").isNotNull(), F.lit(run_ts).cast("timestamp_ntz")).otherwise(F.col("parsing_date"))}
    if "canonical_url" in urls.columns:
        value["canonical_url"] = F.coalesce("_canonical", "canonical_url")
    rows = written.select(*[value.get(c, F.col(c)).alias(c) for c in urls.columns])
    named = parsed.where("url <> page_url").select(F.col("url").alias("_named")).distinct()
    order = [c for c in ("parsing_date", "last_check", "data_hash") if c in urls.columns]
    touched = latest_per_key(rows.join(named, F.col("url") == F.col("_named"), "left_semi"), ["url"], order)
    return rows.join(named, F.col("url") == F.col("_named"), "left_anti").unionByName(touched)


def aliases(known: DataFrame, parsed: DataFrame) -> DataFrame:
    """``seen_url, url`` of all urls whose page named another one; known ones are led on to what their url is now."""
    moved = parsed.where("url <> page_url").groupBy(F.col("page_url").alias("seen_url")).agg(F.max("url").alias("url"))
    step = moved.select(F.col("seen_url").alias("_from"), F.col("url").alias("_to"))
    led = known.join(step, F.col("url") == F.col("_from"), "left").select("seen_url", F.coalesce("_to", "url").alias("url"))
    return led.join(moved.select("seen_url"), "seen_url", "left_anti").unionByName(moved)


def resolve(batch: DataFrame, known: DataFrame, url: str = "url") -> DataFrame:
    """``batch`` with urls that are aliases replaced by what they stand for."""
    names = known.select(F.col("seen_url").alias("_seen"), F.col("url").alias("_stands_for"))
    return batch.join(names, F.col(url) == F.col("_seen"), "left").select(
        *[F.coalesce("_stands_for", url).alias(c) if c == url else c for c in batch.columns])


def newest_results(results: DataFrame) -> DataFrame:
    return latest_per_key(results, ["url"], ["ts", "event_id"])
