"""Upserts, links, deletes, restores and the fetch and parse write-backs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from jobsignal import schemas as S
from jobsignal.operators import chat as chat_ops
from jobsignal.operators import fetching, merge, reshape
from jobsignal.plans import datasets as T
from jobsignal.plans import expected as E
from jobsignal.plans.registry import registry
from jobsignal.sources import fixtures
from jobsignal.sources.bodies import bodies_of, body_key, keyed, with_body

QUERIES, query = registry()

# State before the batch = rows before SINCE; the batch re-reads from AGAIN on.
SINCE, AGAIN = "1998-01-01", "1997-01-01"
RUN_TS = datetime(2025, 6, 1, 12, 0, 0)


def _before(column: str = "date"):
    return F.col(column) < F.lit(SINCE).cast("timestamp_ntz")


def _batch(column: str = "date"):
    return F.col(column) >= F.lit(AGAIN).cast("timestamp_ntz")


_OUTCOME = (f"CASE WHEN date < TIMESTAMP '{AGAIN}' THEN 'kept' WHEN date < TIMESTAMP '{SINCE}' THEN 'updated' "
            "ELSE 'added' END AS outcome")


@query("upsert_generic", """
WITH e AS (SELECT *, ts < TIMESTAMP '2024-01-16' AS old FROM events),
o AS (SELECT * FROM e WHERE old QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
b AS (SELECT * FROM e WHERE NOT old QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT coalesce(b.user_id, o.user_id) AS user_id, coalesce(b.value, o.value) AS value, o.props AS first_props,
  CASE WHEN b.user_id IS NULL THEN 'kept' WHEN o.user_id IS NULL THEN 'added' ELSE 'updated' END AS outcome
FROM o FULL JOIN b ON o.user_id = b.user_id""")
def upsert_generic(spark, sf_dir):
    """Only ``value`` is updated; ``props`` stays as the target has it."""
    events = T.table(spark, sf_dir, "events")
    old = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    target = merge.latest_per_key(events.where(old).select("user_id", "value", "props", "ts", "event_id"),
                                  ["user_id"], ["ts", "event_id"])
    result = merge.upsert(target.select("user_id", "value", F.col("props").alias("first_props")), events.where(~old),
                          ["user_id"], ["value"], ["ts", "event_id"])
    return result


@query("latest_per_key", """
SELECT user_id, event_id, event_type, value, n AS writes FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n FROM events)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark, sf_dir):
    events = T.table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return merge.latest_per_key(events, ["user_id"], ["ts", "event_id"], writes="writes").drop("ts")


@query("upsert_raw", E.with_(E.PARTS, E.CHAT_TEXT, E.CHAT_TYPES) + f"""
SELECT message_id, CASE WHEN t.date < TIMESTAMP '{AGAIN}' THEN 'first read' ELSE text END AS text, message_type_id, {_OUTCOME.replace('date <', 't.date <')}
FROM chat_text t JOIN chat_types USING (message_id)""")
def upsert_raw(spark, sf_dir):
    """Stored messages carry a placeholder text; re-read ones get their current text."""
    chat = T.typed_chat(spark, sf_dir)
    stored = chat.where(_before()).withColumn("text", F.lit("first read"))
    return merge.upsert(stored.select("message_id", "text", "message_type_id"), chat.where(_batch()), ["message_id"],
                        ["text", "message_type_id"], ["date", "message_id"])


@query("upsert_vacancy", E.with_(E.PARTS, E.CHAT) + f"""
SELECT data_hash, CASE WHEN date < TIMESTAMP '{AGAIN}' THEN 'old error' END AS message_parsing_error, {_OUTCOME} FROM chat""")
def upsert_vacancy(spark, sf_dir):
    parts = T.chat_vacancies(spark, sf_dir).withColumn("message_parsing_error", F.col("parsing_error"))
    stored = parts.where(_before()).select("data_hash", F.lit("old error").alias("message_parsing_error"))
    return merge.upsert(stored, parts.where(_batch()), ["data_hash"], ["message_parsing_error"],
                        ["date", "message_id", "part_no"])


def _stored_urls(parts):
    """Url table after the first run: newest vacancy per url, every page fetched."""
    newest = merge.latest_per_key(parts.where(_before()).select("url", "data_hash", *ORDER), ["url"], ORDER)
    return _paged(newest)


def _paged(urls):
    """Urls with a fetched page each, held by its key."""
    return urls.select("url", body_key(F.lit("page")).alias("page_key"), F.lit(200).alias("status_code"), "data_hash")


def _with_pages(urls, pages):
    """The url table with the pages themselves, read by key from the distinct ones."""
    return with_body(urls, bodies_of(pages, "raw_html").dropDuplicates(["body_key"]), "page_key", "raw_html")


ORDER = ["date", "message_id", "part_no"]


def _url_sql(source: str, html: str, status: str) -> str:
    last = "QUALIFY row_number() OVER (PARTITION BY url ORDER BY date DESC, id DESC, part_no DESC) = 1"
    return f""",
r AS (SELECT url, data_hash, date, {source} AS id, part_no FROM src),
o AS (SELECT * FROM r WHERE date < (SELECT s FROM cut) {last}), b AS (SELECT * FROM r WHERE date >= (SELECT a FROM cut) {last})
SELECT coalesce(o.url, b.url) AS url, CASE WHEN o.url IS NULL THEN NULL {html} ELSE 'page' END AS raw_html,
  CASE WHEN o.url IS NULL THEN NULL {status} ELSE 200 END::INTEGER AS status_code,
  coalesce(b.data_hash, o.data_hash) AS data_hash,
  CASE WHEN o.url IS NULL THEN 'added' WHEN b.url IS NULL THEN 'kept' ELSE 'updated' END AS outcome
FROM o FULL JOIN b ON o.url = b.url"""


@query("upsert_url_chat", E.with_(E.PARTS, E.CHAT, "src AS (SELECT * FROM chat)", f"cut AS (SELECT TIMESTAMP '{SINCE}' AS s, TIMESTAMP '{AGAIN}' AS a)").rstrip()
       + _url_sql("message_id", "", ""))
def upsert_url_chat(spark, sf_dir):
    """A known url keeps its page; the pointer moves to the newest vacancy."""
    parts = T.chat_vacancies(spark, sf_dir)
    done = fetching.point_urls(_stored_urls(parts), parts.where(_batch()).select("url", "data_hash", *ORDER), ORDER)
    return _with_pages(done, spark.range(1).select(F.lit("page").alias("raw_html")))


MAIL_CUT = "cut AS (SELECT TIMESTAMP '2025-03-01' AS s, TIMESTAMP '2024-12-01' AS a)"


@query("upsert_url_email_reset", E.with_(E.PARTS, E.MAIL, "src AS (SELECT * FROM mail)", MAIL_CUT).rstrip()
       + _url_sql("email_uid", "WHEN b.url IS NOT NULL THEN NULL", "WHEN b.url IS NOT NULL THEN NULL"))
def upsert_url_email_reset(spark, sf_dir):
    """A url seen again loses its page and status."""
    order = ["date", "email_uid", "part_no"]
    parts = T.mail_vacancies(spark, sf_dir).select("url", "data_hash", *order)
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    stored = _paged(merge.latest_per_key(parts.where(F.col("date") < at("2025-03-01")), ["url"], order))
    done = fetching.reset_known_urls(stored, parts.where(F.col("date") >= at("2024-12-01")), order)
    return _with_pages(done, spark.range(1).select(F.lit("page").alias("raw_html")))


@query("upsert_attr", E.with_(E.PARTS, E.CHAT, E.CHAT_LONG, f"""
o AS (SELECT DISTINCT attr_id, attr_value FROM chat_eav WHERE date < TIMESTAMP '{SINCE}'),
b AS (SELECT DISTINCT attr_id, attr_value FROM chat_eav WHERE date >= TIMESTAMP '{AGAIN}')""") + """
SELECT coalesce(b.attr_id, o.attr_id) AS attr_id, coalesce(b.attr_value, o.attr_value) AS attr_value,
  CASE WHEN b.attr_id IS NULL THEN 1 ELSE 3 END AS attr_source_id,
  CASE WHEN b.attr_id IS NULL THEN 'kept' WHEN o.attr_id IS NULL THEN 'added' ELSE 'updated' END AS outcome
FROM o FULL JOIN b ON o.attr_id = b.attr_id AND o.attr_value = b.attr_value""")
def upsert_attr(spark, sf_dir):
    """The source of a value is its last writer's; the stored ones came from the web."""
    long = T.chat_long(spark, sf_dir)
    stored = long.where(_before()).select("attr_id", "attr_value").distinct().withColumn("attr_source_id", F.lit(S.WEB))
    return merge.upsert_attrs(stored, long.where(_batch()).withColumn("attr_source_id", F.lit(S.CHAT)), ORDER)


def _one_to_one(spark, sf_dir, kind: int):
    chat = T.typed_chat(spark, sf_dir).where(F.col("message_type_id") == kind)
    rows = chat_ops.extract_statistics(chat) if kind == S.CHAT_STATISTIC else chat
    return rows.withColumn("raw_key", F.concat(F.lit("chat-"), F.col("message_id")))


@query("upsert_statistic", f"""
SELECT 'chat-' || o_orderkey AS raw_key, CASE WHEN date < TIMESTAMP '{AGAIN}' THEN 0 ELSE (o_orderkey % 500) END::DOUBLE AS vacancies_in_30d,
  CASE WHEN date < TIMESTAMP '{AGAIN}' THEN 0 ELSE 1000 + o_orderkey % 100 END::DOUBLE AS min_salary, {_OUTCOME}
FROM (SELECT *, o_orderdate AS date FROM orders) WHERE o_orderkey % 10 = 7""")
def upsert_statistic(spark, sf_dir):
    rows = _one_to_one(spark, sf_dir, S.CHAT_STATISTIC)
    stored = rows.where(_before()).select("raw_key", F.lit(0.0).alias("vacancies_in_30d"), F.lit(0.0).alias("min_salary"))
    return merge.upsert(stored, rows.where(_batch()), ["raw_key"], ["vacancies_in_30d", "min_salary"], ["date", "message_id"])


@query("upsert_service", E.with_(E.PARTS, E.CHAT_TEXT, E.CHAT_TYPES) + f"""
SELECT 'chat-' || message_id AS raw_key, CASE WHEN t.date < TIMESTAMP '{AGAIN}' THEN 'old' ELSE text END AS text, {_OUTCOME.replace('date <', 't.date <')}
FROM chat_text t JOIN chat_types USING (message_id) WHERE message_type_id = 3""")
def upsert_service(spark, sf_dir):
    rows = _one_to_one(spark, sf_dir, S.CHAT_SERVICE)
    stored = rows.where(_before()).select("raw_key", F.lit("old").alias("text"))
    return merge.upsert(stored, rows.where(_batch()), ["raw_key"], ["text"], ["date", "message_id"])


# ----------------------------------------------------------- links and deletes

@query("link_append", E.with_(E.PARTS, E.CHAT, E.CHAT_LONG) + """
SELECT data_hash, attr_id, attr_value FROM chat_eav""")
def link_append(spark, sf_dir):
    """Old links plus the batch's new ones; re-read vacancies add nothing twice."""
    long, keys = T.chat_long(spark, sf_dir), ["data_hash", "attr_id", "attr_value"]
    return merge.append_links(long.where(_before()).select(*keys), long.where(_batch()).select(*keys))


@query("cascade_delete", E.with_(E.PARTS, E.CHAT, E.CHAT_TYPES, E.CHAT_LONG, """
last AS (SELECT url, arg_max(message_id, struct_pack(d := date, m := message_id, p := part_no)) AS m,
  arg_max(date, struct_pack(d := date, m := message_id, p := part_no)) AS d FROM chat GROUP BY url)""") + f"""
SELECT 'vacancies' AS child, data_hash AS k, message_id AS parent FROM chat WHERE date < TIMESTAMP '{SINCE}'
UNION ALL SELECT 'vacancy_web', url, m FROM last WHERE d < TIMESTAMP '{SINCE}'
UNION ALL SELECT 'statistic', message_id::VARCHAR, message_id FROM chat_types WHERE message_type_id = 2 AND date < TIMESTAMP '{SINCE}'
UNION ALL SELECT 'service', message_id::VARCHAR, message_id FROM chat_types WHERE message_type_id = 3 AND date < TIMESTAMP '{SINCE}'
UNION ALL SELECT 'vacancy_data_vacancies_links', data_hash || ' ' || attr_id || ' ' || attr_value, NULL FROM chat_eav WHERE date < TIMESTAMP '{SINCE}'""")
def cascade_delete(spark, sf_dir):
    """Rows left in every child table after the newer messages were deleted."""
    chat, parts = T.typed_chat(spark, sf_dir), T.chat_vacancies(spark, sf_dir)
    urls = merge.latest_per_key(parts.select("url", *ORDER), ["url"], ORDER)
    children = {"vacancies": (parts, "message_id"), "vacancy_web": (urls, "message_id"),
                "statistic": (chat.where("message_type_id = 2"), "message_id"),
                "service": (chat.where("message_type_id = 3"), "message_id")}
    left = merge.cascade_delete(children, chat.where(~_before()), "message_id")
    keys = {"vacancies": "data_hash", "vacancy_web": "url"}
    rows = [df.select(F.lit(name).alias("child"), F.col(keys.get(name, "message_id")).cast("string").alias("k"), F.col("message_id").alias("parent"))
            for name, df in left.items()]
    links = T.chat_long(spark, sf_dir).select("data_hash", "attr_id", "attr_value")
    kept = merge.cascade_delete({"links": (links, "data_hash")}, parts.where(~_before()), "data_hash")["links"]
    rows.append(kept.select(F.lit("vacancy_data_vacancies_links").alias("child"), F.concat_ws(" ", "data_hash", "attr_id", "attr_value").alias("k"),
                            F.lit(None).cast("long").alias("parent")))
    result = rows[0]
    for part in rows[1:]:
        result = result.unionByName(part)
    return result


# --------------------------------------------------------------- fetch and web

def _fetched_urls(spark, sf_dir):
    newest = T.newest_fetch(spark, sf_dir).select(
        "url", body_key("html").alias("page_key"), F.col("ts").alias("last_check"), F.col("status").alias("status_code"))
    return fetching.apply_fetch(T.user_urls(spark, sf_dir), newest, ["last_check"]).drop("outcome")


def _fetched_pages(spark, sf_dir):
    return fetching.detect_blocked(T.fetch_results(spark, sf_dir)).select(F.col("html").alias("raw_html"))


@query("apply_fetch", E.with_(E.FETCH) + """
SELECT url, html AS raw_html, status AS status_code, epoch_us(ts) AS checked_us, true AS unparsed FROM newest""")
def apply_fetch(spark, sf_dir):
    """Every attempt of the log is applied; the newest one per url decides."""
    results = fetching.detect_blocked(T.fetch_results(spark, sf_dir)).select(
        "url", body_key("html").alias("page_key"), F.col("ts").alias("last_check"), F.col("status").alias("status_code"),
        "event_id")
    urls = T.user_urls(spark, sf_dir).withColumn("parsing_date", F.lit(RUN_TS).cast("timestamp_ntz"))
    done = _with_pages(fetching.apply_fetch(urls, results, ["last_check", "event_id"]), _fetched_pages(spark, sf_dir))
    return done.select("url", "raw_html", "status_code", F.unix_micros(F.col("last_check").cast("timestamp")).alias("checked_us"),
                       F.col("parsing_date").isNull().alias("unparsed"))


@query("detect_blocked", E.with_(E.FETCH) + """
SELECT event_id, CASE WHEN contains(html, 'Your IP address') AND contains(html, 'has been blocked') THEN 429 ELSE status END AS status FROM fetched""")
def detect_blocked(spark, sf_dir):
    return fetching.detect_blocked(T.fetch_results(spark, sf_dir)).select("event_id", "status")


@query("refetch_candidates", E.with_(E.FETCH) + "SELECT url FROM newest WHERE status NOT IN (200, 404)")
def refetch_candidates(spark, sf_dir):
    return fetching.refetch_candidates(_fetched_urls(spark, sf_dir))


@query("parse_due", E.with_(E.FETCH, """
raw AS (SELECT user_id, min(ts) AS date FROM events GROUP BY user_id)""") + """
SELECT event_id, user_id FROM fetched JOIN raw USING (user_id)
WHERE status = 200 AND NOT contains(html, 'has been blocked')
  AND (event_id % 3 = 2 OR event_id % 3 = 1 OR date >= TIMESTAMP '2024-01-01 03:00:00')""")
def parse_due(spark, sf_dir):
    """Every attempt as a page row: parsed later, parsed earlier or never parsed."""
    third, hour = F.col("event_id") % 3, F.expr("INTERVAL 1 HOUR")
    pages = fetching.detect_blocked(T.fetch_results(spark, sf_dir)).select(
        F.col("user_id").alias("data_hash"), "event_id", F.col("status").alias("status_code"),
        F.col("ts").alias("last_check"),
        F.when(third == 0, F.col("ts") + hour).when(third == 1, F.col("ts") - hour).alias("parsing_date"))
    raw = T.table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("raw_key")).agg(F.min("ts").alias("date"))
    vacancies = raw.select(F.col("raw_key").alias("data_hash"), "raw_key")
    joined = fetching.join_web_vacancy_raw(pages, vacancies, raw)
    return fetching.parse_due(joined, datetime(2024, 1, 1, 3)).select("event_id", F.col("data_hash").alias("user_id"))


@query("join_web_vacancy_raw", """
SELECT l_orderkey AS data_hash, l_linenumber, l_partkey, c_name FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""")
def join_web_vacancy_raw(spark, sf_dir):
    pages = T.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("data_hash"), "l_linenumber", "l_partkey")
    vacancies = T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("data_hash"), F.col("o_custkey").alias("raw_key"))
    raw = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("raw_key"), "c_name")
    return fetching.join_web_vacancy_raw(pages, vacancies, raw).drop("raw_key")


BACKUP = """balance AS (SELECT user_id, count(*) FILTER (event_type = 'error') > count(*) FILTER (event_type = 'view') AS lost
  FROM events GROUP BY user_id),
backup AS (SELECT url, CASE WHEN NOT lost THEN 'backup ' || event_id END AS raw_html, 200 AS status_code, ts AS last_check
  FROM fetched JOIN balance USING (user_id) WHERE status = 404
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) = 1)"""


@query("restore_from_backup", E.with_(E.FETCH, BACKUP) + """
SELECT n.url, CASE WHEN b.url IS NOT NULL THEN b.raw_html ELSE n.html END AS raw_html,
  CASE WHEN b.url IS NOT NULL THEN b.status_code ELSE n.status END AS status_code,
  epoch_us(CASE WHEN b.url IS NOT NULL THEN b.last_check ELSE n.ts END) AS checked_us
FROM newest n LEFT JOIN backup b ON n.url = b.url""")
def restore_from_backup(spark, sf_dir):
    backup = fixtures.url_backup(spark, sf_dir)
    restored = merge.restore_from_backup(
        _fetched_urls(spark, sf_dir), keyed(backup, raw_html="page_key"), "url", ["page_key", "status_code", "last_check"], ["last_check", "event_id"])
    pages = _fetched_pages(spark, sf_dir).union(backup.select("raw_html"))
    return _with_pages(restored, pages).select("url", "raw_html", "status_code",
                           F.unix_micros(F.col("last_check").cast("timestamp")).alias("checked_us"))


@query("semi_join_known_urls", E.with_(E.FETCH, BACKUP) + """
SELECT event_id, url FROM fetched WHERE url IN (SELECT url FROM backup WHERE raw_html IS NOT NULL)""")
def semi_join_known_urls(spark, sf_dir):
    saved = fixtures.url_backup(spark, sf_dir).where("raw_html IS NOT NULL").select("url").distinct()
    return T.fetch_results(spark, sf_dir).join(saved, "url", "left_semi").select("event_id", "url")


@query("apply_web_parse", E.with_(E.PARTS, E.CHAT, E.WEB, """
u AS (SELECT 'https://djinni.co/jobs/' || pk AS page_url, data_hash FROM chat
  QUALIFY row_number() OVER (PARTITION BY pk ORDER BY date DESC, message_id DESC, part_no DESC) = 1),
w AS (SELECT u.data_hash, web.* FROM u JOIN web USING (page_url)),
long AS (SELECT data_hash, unnest([1, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15, 18, 19])::INTEGER AS attr_id,
  unnest([position, experience::BIGINT::VARCHAR, main_tech, tech_stack, lingvo, salary_from::BIGINT::VARCHAR,
    salary_to::BIGINT::VARCHAR, company, company_type, domain, offices, employment, candidate_locations, job_desc,
    notes]) AS attr_value FROM w WHERE linked)""", E.CHAT_LONG) + f"""
SELECT 'link' AS part, data_hash AS k, attr_id, attr_value AS v FROM chat_eav
UNION SELECT 'link', data_hash, attr_id, attr_value FROM long WHERE attr_value IS NOT NULL
UNION ALL SELECT 'url', page_url, CASE WHEN linked IS NULL THEN 0 ELSE 1 END, data_hash FROM u LEFT JOIN web USING (page_url)
UNION ALL SELECT 'error', data_hash, NULL, {E.WEB_ERROR} FROM w""")
def apply_web_parse(spark, sf_dir):
    """Links, urls with their parsed flag, and page errors after the pages were parsed."""
    parts, pages = T.chat_vacancies(spark, sf_dir), T.web_vacancies(spark, sf_dir)
    spelled = parts.withColumn("url", F.concat(F.lit("https://djinni.co/jobs/"), F.regexp_extract("url", r"jobs/(\d+)", 1)))
    urls = merge.latest_per_key(spelled.select("url", "data_hash", *ORDER), ["url"], ORDER).select(
        "url", "data_hash", F.lit(None).cast("timestamp_ntz").alias("parsing_date"))
    parsed = pages.join(urls.select(F.col("url").alias("page_url"), "data_hash"), "page_url")
    stored = T.chat_long(spark, sf_dir).select("data_hash", "attr_id", "attr_value")
    found = reshape.to_long(parsed.where("quarantine IS NULL"), ["data_hash"])
    links = merge.append_links(stored, found)
    done = fetching.apply_web_parse(urls, pages, RUN_TS)
    null_int = F.lit(None).cast("int")
    return (links.select(F.lit("link").alias("part"), F.col("data_hash").alias("k"), "attr_id", F.col("attr_value").alias("v"))
            .unionByName(done.select(F.lit("url").alias("part"), F.col("url").alias("k"),
                                     F.col("parsing_date").isNotNull().cast("int").alias("attr_id"), F.col("data_hash").alias("v")))
            .unionByName(parsed.select(F.lit("error").alias("part"), F.col("data_hash").alias("k"), null_int.alias("attr_id"),
                                       F.col("parsing_error").alias("v"))))
