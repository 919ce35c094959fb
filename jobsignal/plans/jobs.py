"""The three ingestion jobs over the vacancy store: chat, mail and web.

Each job reads a landed batch, extracts, merges every table and publishes all new
versions with one commit. Batches are staged as tables because several merges read
them: their size is then exact, and a lost executor re-reads files.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal import schemas as S
from jobsignal.functions import scalars as X
from jobsignal.operators import chat as chat_ops
from jobsignal.operators import classify, fetching, mail as mail_ops, merge, reshape
from jobsignal.plans import datasets
from jobsignal.sources import bodies, landing
from jobsignal.sources.store import Store

_ORDER = ["date", "ident", "part_no"]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _typed_null(df: DataFrame, table: str) -> DataFrame:
    """Add the table's columns the frame lacks as typed NULLs."""
    missing = [f for f in S.TABLES[table].fields if f.name not in df.columns]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def _month(date: str = "date") -> Column:
    return F.date_format(date, "yyyy-MM").alias("month")


def _raw(store: Store, newest: DataFrame) -> None:
    """Merge raw messages given one row per key; their texts go to the bodies."""
    _bodies(store, newest, "text", "html")
    rows = newest.withColumns({"text_key": bodies.body_key("text"), "html_key": bodies.body_key("html")})
    update = [c for c in S.TABLES["raw_messages"].names if c != "raw_key"]
    batch = rows.select("raw_key", *update)
    store.merge("raw_messages", ["raw_key"], batch, lambda old: merge.upsert(old, batch, ["raw_key"], update, ["date"], collapsed=True))


def _bodies(store: Store, df: DataFrame, *columns: str) -> None:
    """Store the texts of these columns that are new."""
    given = store.stage("_bodies", bodies.bodies_of(df, *columns).withColumn("_place", F.monotonically_increasing_id()))
    store.append("bodies", bodies.new_bodies(store.read("bodies"), given))


def _quarantine(store: Store, bad: DataFrame) -> None:
    """Append the rows that are not there yet; they are compared by a 128-bit key of message, part, reason and payload."""
    def key() -> Column:
        text = F.to_json(F.struct("raw_key", "part_no", "reason", "payload"), {"ignoreNullFields": "false"})
        return bodies.body_key(text).alias("_key")

    rows = store.stage("_quarantine", _typed_null(bad, "quarantine").select(*S.TABLES["quarantine"].names, key()))
    known = store.read("quarantine").select(key())
    store.append("quarantine", rows.dropDuplicates(["_key"]).join(known, "_key", "left_anti").drop("_key"))


def _vacancies(store: Store, parts: DataFrame, source: int, kind: str) -> list[DataFrame]:
    """Merge urls, vacancies, attribute values and links of staged good parts."""
    urls, vacancies = store.read("vacancy_web"), store.read("vacancies")
    parts = fetching.resolve(parts, store.read("url_aliases"))
    counters = [merge.count_outcomes(f"{kind}_URL", parts, ["url"], urls),
                merge.count_outcomes(f"{kind}_VACANCY", parts, ["data_hash"], vacancies)]
    batch = parts.select("url", X.canonical_url(F.col("url")).alias("canonical_url"), "data_hash", *_ORDER)
    on_match = {"page_key": F.lit(None).cast("binary"), "status_code": F.lit(None).cast("int")}
    store.stage("vacancy_web", merge.upsert(urls, batch, ["url"], ["canonical_url", "data_hash"], _ORDER,
                                            on_match=on_match if source == S.EMAIL else None))
    rows = parts.select("data_hash", "raw_key", F.col("parsing_error").alias("message_parsing_error"), _month(), *_ORDER)
    # A vacancy key holds the message's id and the part number, so a batch has each once.
    store.merge("vacancies", ["data_hash"], rows, lambda old: merge.upsert(
        old, rows, ["data_hash"], ["raw_key", "message_parsing_error", "month"], _ORDER, collapsed=True))
    _attributes(store, reshape.to_long(parts, ["data_hash", *_ORDER]), source)
    return counters


def _attributes(store: Store, long: DataFrame, source: int, written: Column | None = None) -> None:
    """Merge values and their links; ``written`` is when the source said so, the message's date by default."""
    at = F.col("date") if written is None else written
    staged = store.stage("_long", long.withColumns({"attr_source_id": F.lit(source), "written": at.cast("timestamp_ntz"), "month": _month()}))
    store.stage("vacancy_data", merge.upsert_attrs(store.read("vacancy_data"), staged, _ORDER))
    store.merge("vacancy_data_vacancies_links", ["data_hash"], staged, lambda old: merge.upsert_links(old, staged))


def _report(store: Store, counters: list[DataFrame]) -> DataFrame:
    """Publish the run; the counters are staged with it because they compare old and new state."""
    staged = store.stage("_counters", _union(counters).groupBy("label").agg(F.sum("n").alias("n")))
    store.commit()
    return staged.orderBy("label")


def ingest_chat(store: Store, messages: DataFrame) -> DataFrame:
    """One run over new chat messages (``message_id, date, text``); returns the counters."""
    usable = messages.where(F.col("date").isNotNull() & F.col("message_id").isNotNull())
    typed = chat_ops.raw_audit(classify.with_chat_type(usable))
    batch = store.stage("_batch", _typed_null(typed.select(
        F.concat(F.lit("chat-"), F.col("message_id")).alias("raw_key"), "*", F.col("message_id").alias("ident"),
        F.lit(S.CHAT).alias("message_source_id"), F.lit(None).cast("string").alias("html"), F.monotonically_increasing_id().alias("_row")), "raw_messages"))
    newest = store.stage("_newest", merge.without_older(batch, ["raw_key"], ["date", "ident"], "_row"))
    counters = [batch.agg(F.count(F.lit(1)).alias("n")).select(F.lit("TELEGRAM").alias("label"), "n"),
                merge.count_outcomes("TG_RAW", batch, ["raw_key"], store.read("raw_messages"))]

    parts = datasets.extract_chat(newest.select("raw_key", "message_id", "date", "text", "message_type_id"),
                                  keep=["raw_key"]).withColumn("ident", F.col("message_id"))
    staged = store.stage("_parts", parts)
    good = staged.where(F.col("quarantine").isNull())
    counters += _vacancies(store, good, S.CHAT, "TG")

    for table, kind, label in (("statistic", S.CHAT_STATISTIC, "TG_STATISTIC"), ("service", S.CHAT_SERVICE, "TG_SERVICE")):
        old, of_kind = store.read(table), F.col("message_type_id") == kind
        counters.append(merge.count_outcomes(label, batch.where(of_kind), ["raw_key"], old))
        rows = newest.where(of_kind)
        rows = chat_ops.extract_statistics(rows) if table == "statistic" else rows
        update = [c for c in old.columns if c != "raw_key"]
        store.stage(table, merge.upsert(old, rows, ["raw_key"], update, ["date", "ident"], collapsed=True))

    undated = messages.where(F.col("date").isNull() | F.col("message_id").isNull()).select(
        F.concat(F.lit("chat-"), F.col("message_id")).alias("raw_key"), F.lit("missing_date").alias("reason"),
        F.col("text").alias("payload"))
    bad = staged.where(F.col("quarantine").isNotNull()).select(
        "raw_key", "part_no", F.col("quarantine").alias("reason"), "payload")
    _quarantine(store, bad.unionByName(undated, allowMissingColumns=True))
    _raw(store, newest)
    return _report(store, counters)


def ingest_mail(store: Store, mails: DataFrame) -> DataFrame:
    """One run over parsed mails (``email_uid, date, text, html``); returns the counters."""
    usable = landing.mail_audit(mails.where(F.col("date").isNotNull())).select(
        F.concat(F.lit("mail-"), F.col("email_uid")).alias("raw_key"), "email_uid", "date", "text", "html", "raw_parsing_error",
        F.col("email_uid").alias("ident"), F.lit(S.EMAIL).alias("message_source_id"), F.monotonically_increasing_id().alias("_row"))
    batch = store.stage("_batch", usable)
    counters = [batch.agg(F.count(F.lit(1)).alias("n")).select(F.lit("EMAIL").alias("label"), "n"),
                merge.count_outcomes("EMAIL_RAW", batch, ["raw_key"], store.read("raw_messages"))]
    winners = merge.without_older(batch, ["raw_key"], ["date", "ident"], "_row")
    routed = mail_ops.route_template(winners.withColumn("raw", F.col("html")))
    read = _union([mail_ops.hits_of(routed.where(F.col("layout") == i), i) for i in (0, 1)])
    typed = read.withColumn("message_type_id", classify.mail_type(F.col("nodes"))).withColumnRenamed("raw", "html")
    newest = store.stage("_newest", _typed_null(typed, "raw_messages"))
    parts = datasets.extract_shredded_mail(newest.select("raw_key", "email_uid", "date", "nodes"))
    staged = store.stage("_parts", parts.withColumn("ident", F.col("email_uid")))
    counters += _vacancies(store, staged.where(F.col("quarantine").isNull()), S.EMAIL, "EMAIL")
    undated = mails.where(F.col("date").isNull()).select(
        F.concat(F.lit("mail-"), F.col("email_uid")).alias("raw_key"), F.lit("missing_date").alias("reason"))
    bad = staged.where(F.col("quarantine").isNotNull()).select("raw_key", "part_no", F.col("quarantine").alias("reason"))
    _quarantine(store, bad.unionByName(undated, allowMissingColumns=True))
    _raw(store, newest)
    return _report(store, counters)


def ingest_new_chat(store: Store, landed: DataFrame) -> DataFrame:
    """One run over the landed messages from the stored mark on; the mark itself is read again, older files are pruned by date."""
    mark = landing.high_water(store.read("raw_messages").select("message_source_id", "date"), S.CHAT)
    return ingest_chat(store, landing.new_chat(landed, mark))


def ingest_new_mail(store: Store, landed: DataFrame) -> DataFrame:
    """One run over the landed mails since the day of the stored mark."""
    mark = landing.high_water(store.read("raw_messages").select("message_source_id", "date"), S.EMAIL)
    return ingest_mail(store, landing.new_mail(landed, mark))


def urls_to_fetch(store: Store) -> DataFrame:
    """Output for the external fetcher."""
    return fetching.refetch_candidates(store.read("vacancy_web")).distinct()


def _fetch_log(log: DataFrame) -> DataFrame:
    """Logs without a fetch time hold one answer per url or equally new ones."""
    return log if "fetched" in log.columns else log.withColumn("fetched", F.lit(None).cast("timestamp_ntz"))


def ingest_fetches(store: Store, log: DataFrame, run_ts: datetime) -> DataFrame:
    """One run over a landed fetch log (``url, status, html``)."""
    results = fetching.detect_blocked(fetching.fetch_rows(_fetch_log(log))).select(
        "url", "fetched", "html", bodies.body_key("html").alias("page_key"), F.col("status").alias("status_code"),
        F.lit(run_ts).cast("timestamp_ntz").alias("last_check"))
    whole = store.stage("_batch", fetching.resolve(results, store.read("url_aliases")))
    _bodies(store, whole, "html")
    batch = whole.drop("html").withColumn("canonical_url", X.canonical_url(F.col("url")))
    urls = store.read("vacancy_web")
    counters = [merge.count_outcomes("WEB_URL", batch, ["url"], urls)]
    rows = batch.withColumn("parsing_date", F.lit(None).cast("timestamp_ntz"))
    # Several answers for one url in a log: the newest counts, and of equally new ones a full page beats an error.
    order = ["fetched", "status_rank", "page_key"]
    ranked = rows.withColumn("status_rank", F.when(F.col("status_code") == 200, 2).when(F.col("status_code") == 404, 1).otherwise(0))
    store.stage("vacancy_web", merge.upsert(
        urls, ranked, ["url"], ["canonical_url", "page_key", "status_code", "last_check", "parsing_date"], order))
    return _report(store, counters)


def parse_pages(store: Store, run_ts: datetime, from_date: datetime | None = None) -> DataFrame:
    """One run over the fetched pages that are due."""
    urls = store.read("vacancy_web")
    joined = fetching.join_web_vacancy_raw(
        urls.select("url", "page_key", "status_code", "last_check", "parsing_date", "data_hash"),
        store.read("vacancies").select("data_hash", "raw_key"), store.read("raw_messages").select("raw_key", "date"))
    # Pages are fetched for the due rows alone, by key.
    due = bodies.with_body(fetching.parse_due(joined, from_date).select("url", "data_hash", "raw_key", "date", "page_key"),
                           store.read("bodies"), "page_key", "html")
    parsed = store.stage("_pages", datasets.extract_web(due))
    good = parsed.where(F.col("quarantine").isNull())
    counters = [parsed.agg(F.count(F.lit(1)).alias("n")).select(F.lit("WEB_VACANCY_PARSED").alias("label"), "n")]

    errors = parsed.select("data_hash", "raw_key", F.col("parsing_error").alias("web_parsing_error"), "date", _month())
    store.merge("vacancies", ["data_hash"], errors, lambda old: merge.upsert(old, errors, ["data_hash"], ["web_parsing_error"], ["date"]))
    long = reshape.to_long(good.withColumn("ident", F.lit(0).cast("bigint")).withColumn("part_no", F.lit(0)),
                           ["data_hash", *_ORDER])
    _attributes(store, long, S.WEB, F.lit(run_ts))
    store.stage("vacancy_web", fetching.apply_web_parse(urls, parsed, run_ts))
    store.stage("url_aliases", fetching.aliases(store.read("url_aliases"), good))
    _quarantine(store, parsed.where(F.col("quarantine").isNotNull()).select(
        "raw_key", F.col("quarantine").alias("reason"), F.col("page_url").alias("payload")))
    return _report(store, counters)


def delete_messages(store: Store, raw_keys: DataFrame) -> DataFrame:
    """One run that deletes raw messages (``raw_key``) and what hangs on them; returns rows left per table.

    Vacancies, statistics and service rows go with their message; links go with their vacancy; urls stay known
    and lose their pointer. Values stay, as other vacancies share them.
    """
    gone = store.stage("_gone", raw_keys.select("raw_key").distinct())
    lost = store.stage("_lost", store.read("vacancies").join(gone, "raw_key", "left_semi").select("data_hash").distinct())
    left = {t: store.drop_rows(t, "raw_key", gone) for t in ("raw_messages", "vacancies")}
    left |= {t: store.stage(t, store.read(t).join(gone, "raw_key", "left_anti")) for t in ("statistic", "service")}
    left["vacancy_data_vacancies_links"] = store.drop_rows("vacancy_data_vacancies_links", "data_hash", lost)
    pointed = lost.select(F.col("data_hash").alias("_lost"))
    urls = store.read("vacancy_web").join(pointed, F.col("data_hash") == F.col("_lost"), "left")
    left["vacancy_web"] = store.stage("vacancy_web", urls.withColumn("data_hash", F.when(F.col("_lost").isNull(), F.col("data_hash"))).drop("_lost"))
    return _report(store, [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("label"), "n") for name, df in left.items()])


def report(store: Store) -> DataFrame:
    """Flat report: one typed row per vacancy with its source, date and urls.

    Numbers are those of the last writer, a page after its message; several urls of a vacancy are joined.
    """
    wide = reshape.typed(reshape.to_wide(store.read("vacancy_data_vacancies_links"), newest=["written", "attr_source_id"]))
    vacancies = store.read("vacancies").select("data_hash", "raw_key", "message_parsing_error", "web_parsing_error")
    raw = store.read("raw_messages").select("raw_key", "date", "message_source_id")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ", ").alias(c)
    urls = store.read("vacancy_web").where("data_hash IS NOT NULL").groupBy("data_hash").agg(joined("url"), joined("canonical_url"))
    return wide.join(vacancies, "data_hash").join(raw, "raw_key").join(urls, "data_hash", "left")
