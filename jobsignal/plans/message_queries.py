"""Classification, extraction, completeness and search."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal import schemas as S
from jobsignal.functions import dom
from jobsignal.operators import analytics, chat as chat_ops, classify, mail as mail_ops, search
from jobsignal.plans import datasets as T
from jobsignal.plans import expected as E
from jobsignal.plans.layouts import LAYOUTS
from jobsignal.plans.registry import registry
from jobsignal.session import input_folder
from jobsignal.sources import landing

QUERIES, query = registry()

_SIGN = {k: E.text(D.any_of(v)) for k, v in D.CHAT_SIGNS.items()}
SQL_TYPE = f"""CASE WHEN regexp_matches(text, {_SIGN['tg_service']}) THEN 3
  WHEN regexp_matches(text, {_SIGN['tg_statistic']}) THEN 2 WHEN regexp_matches(text, {_SIGN['tg_vacancy']}) THEN 1
  WHEN length(text) < 10 AND instr(text, ' ') = 0 THEN 3 ELSE 4 END"""


# --------------------------------------------------------------- classification

@query("classify_chat", E.with_(E.CHAT_TYPES) + f"""
SELECT 'chat' AS origin, message_id AS id, message_type_id FROM chat_types
UNION ALL SELECT 'document', doc_id, {SQL_TYPE} FROM documents""")
def classify_chat(spark, sf_dir):
    chat = T.chat(spark, sf_dir).select(F.lit("chat").alias("origin"), F.col("message_id").alias("id"), "text")
    documents = T.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), "text")
    return classify.with_chat_type(chat.unionByName(documents)).drop("text")


@query("classify_short_command", """
WITH t AS (SELECT 'document' AS origin, doc_id AS id, 0::BIGINT AS turn, text FROM documents
  UNION ALL SELECT 'conversation', conv_id, turn, text FROM conversations)
SELECT origin, id, turn, length(text) < 10 AND instr(text, ' ') = 0 AS short_command FROM t""")
def classify_short_command(spark, sf_dir):
    documents = T.table(spark, sf_dir, "documents").select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    turns = T.table(spark, sf_dir, "conversations").select(
        F.lit("conversation").alias("origin"), F.col("conv_id").alias("id"), "turn", "text")
    return documents.unionByName(turns).select(
        "origin", "id", "turn", classify.is_short_command(F.col("text")).alias("short_command"))


@query("classify_email", """
SELECT o_orderkey AS email_uid, CASE WHEN o_orderkey % 97 = 0 THEN 6 ELSE 5 END::INTEGER AS message_type_id FROM orders""")
def classify_email(spark, sf_dir):
    return T.mail_signs(spark, sf_dir).select("email_uid", classify.mail_type(F.col("nodes")).alias("message_type_id"))


@query("match_selector", """
SELECT 'mail' AS origin, o_orderkey AS id,
  CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 2 = 0 THEN 0 ELSE o_orderkey % 3 + 1 END::INTEGER AS by_class,
  CASE WHEN o_orderkey % 97 = 0 OR o_orderkey % 2 = 1 THEN 0 ELSE o_orderkey % 3 + 1 END::INTEGER AS by_style,
  CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE o_orderkey % 3 + 1 END::INTEGER AS by_text FROM orders
UNION ALL SELECT 'page', page_id, len(regexp_extract_all(html, '<div class="ad">'))::INTEGER, 0,
  len(regexp_extract_all(html, '<a href="[^"]*/[^"]*"'))::INTEGER FROM pages""")
def match_selector(spark, sf_dir):
    """Nodes hit by a class, a style and a substring selector, per document."""
    def hits(nodes_df, origin, key, selectors):
        return nodes_df.select(F.lit(origin).alias("origin"), F.col(key).alias("id"), *[
            F.size(dom.nodes_where(F.col("nodes"), dom.matches(s))).alias(name) for name, s in selectors.items()])

    style = D.MAIL_SIGNS[1]
    mails = hits(T.mail_nodes(spark, sf_dir), "mail", "email_uid", {
        "by_class": D.MAIL_SIGNS[0], "by_style": style, "by_text": D.Selector("a", "href", ("mandrillapp", "?p="))})
    pages = hits(T.page_nodes(spark, sf_dir), "page", "page_id", {
        "by_class": D.Selector("div", "class", ("AD",)), "by_style": style, "by_text": D.Selector("a", "href", ("/",))})
    return mails.unionByName(pages)


@query("route_template", E.with_(E.PARTS, E.MAIL) + "SELECT email_uid, layout FROM mail_dates")
def route_template(spark, sf_dir):
    return mail_ops.route_template(T.mails(spark, sf_dir)).select("email_uid", "layout")


# ------------------------------------------------------------------- extraction

SQL_PART = f"""'**' || p_name || '** в ' || s_name || chr(10) || n_name || ', ' || {E.EXPERIENCE}
  || coalesce(', $' || lo || '-' || hi, '') || chr(10) || 'Line A ' || k || chr(10) || 'Line B' || chr(10)
  || 'https://djinni.co/jobs/' || pk || '-x/' || chr(10) || '__Subscription:__ "' || p_name || '"'"""


@query("split_chat_vacancies", E.with_(E.PARTS) + f"""
SELECT o_orderkey AS message_id, k::INTEGER AS part_no, {SQL_PART} AS part FROM parts WHERE o_orderkey % 10 <= 6""")
def split_chat_vacancies(spark, sf_dir):
    vacancies = T.typed_chat(spark, sf_dir).where(F.col("message_type_id") == S.CHAT_VACANCY)
    return chat_ops.number_parts(vacancies.select("message_id", "text"))


@query("number_parts", E.with_(E.PARTS) + """
SELECT 'chat' AS origin, o_orderkey AS id, k::INTEGER AS part_no FROM parts WHERE o_orderkey % 10 <= 6
UNION ALL SELECT 'mail', o_orderkey, k::INTEGER FROM parts WHERE o_orderkey % 97 <> 0""")
def number_parts(spark, sf_dir):
    vacancies = T.typed_chat(spark, sf_dir).where(F.col("message_type_id") == S.CHAT_VACANCY)
    chat = chat_ops.number_parts(vacancies.select("message_id", "text"))
    mail = T.mail_vacancies(spark, sf_dir)
    return chat.select(F.lit("chat").alias("origin"), F.col("message_id").alias("id"), "part_no").unionByName(
        mail.select(F.lit("mail").alias("origin"), F.col("email_uid").alias("id"), "part_no"))


CHAT_FIELDS = ["position", "company", "location", "experience", "salary_from", "salary_to", "job_desc_prev", "url",
               "subscription"]


@query("extract_chat_vacancy", E.with_(E.PARTS, E.CHAT) + f"""
SELECT message_id, part_no, data_hash, {', '.join(CHAT_FIELDS)} FROM chat""")
def extract_chat_vacancy(spark, sf_dir):
    return T.extract_chat(T.typed_chat(spark, sf_dir)).where("quarantine IS NULL").select(
        "message_id", "part_no", "data_hash", *CHAT_FIELDS)


STATISTICS = """SELECT o_orderkey AS message_id, (o_orderkey % 500)::DOUBLE AS vacancies_in_30d,
  (o_orderkey % 900)::DOUBLE AS candidates_online, o_orderkey % 40 + 0.5::DOUBLE AS responses_to_vacancies,
  CASE WHEN o_orderkey % 50 <> 7 THEN (o_orderkey % 70)::DOUBLE END AS vacancies_per_week,
  (o_orderkey % 80)::DOUBLE AS candidates_per_week, (1000 + o_orderkey % 100)::DOUBLE AS min_salary,
  (2000 + o_orderkey % 100)::DOUBLE AS max_salary,
  CASE WHEN o_orderkey % 50 = 7 THEN '1 | 5, vacancies_per_week' END AS stat_parsing_error
FROM orders WHERE o_orderkey % 10 = 7"""


@query("extract_chat_statistic", STATISTICS)
def extract_chat_statistic(spark, sf_dir):
    rows = T.typed_chat(spark, sf_dir).where(F.col("message_type_id") == S.CHAT_STATISTIC)
    return chat_ops.extract_statistics(rows.select("message_id", "text"))


@query("extract_service", E.with_(E.PARTS, E.CHAT_TEXT, E.CHAT_TYPES) + """
SELECT message_id, text FROM chat_text JOIN chat_types USING (message_id) WHERE message_type_id = 3""")
def extract_service(spark, sf_dir):
    return T.typed_chat(spark, sf_dir).where(F.col("message_type_id") == S.CHAT_SERVICE).select("message_id", "text")


def _mail_layout(spark, sf_dir, layout: int):
    nodes = mail_ops.hits_of(mail_ops.route_template(T.mails(spark, sf_dir)).where(F.col("layout") == layout), layout)
    cards = mail_ops.extract_v0(nodes) if layout == 0 else mail_ops.extract_v1(nodes)
    return cards.select("email_uid", "part_no", *mail_ops.FIELDS, "parsing_error", "quarantine")


def _mail_sql(layout: str) -> str:
    return E.with_(E.PARTS, E.MAIL) + f"""
SELECT email_uid, part_no, {E.MAIL_FIELDS}, {E.MAIL_ERROR} AS parsing_error,
  CASE WHEN short THEN 'short_details' END AS quarantine FROM mail WHERE layout = {layout}"""


@query("extract_mail_v0", _mail_sql("0"))
def extract_mail_v0(spark, sf_dir):
    return _mail_layout(spark, sf_dir, 0)


@query("extract_mail_v1", _mail_sql("1"))
def extract_mail_v1(spark, sf_dir):
    return _mail_layout(spark, sf_dir, 1)


@query("extract_web_page", E.with_(E.WEB) + f"""
SELECT page_url, {E.WEB_FIELDS}, url, {E.WEB_ERROR} AS parsing_error,
  CASE WHEN NOT linked THEN 'missing_url' END AS quarantine FROM web""")
def extract_web_page(spark, sf_dir):
    return T.extract_web(T.pages(spark, sf_dir))


@query("parser_registry", E.with_(E.PARTS, E.CHAT, E.MAIL, E.WEB) + """
SELECT 'chat' AS layout, data_hash AS id, position, url FROM chat
UNION ALL SELECT 'mail', data_hash, position, url FROM mail
UNION ALL SELECT 'web', page_url, position, url FROM web""")
def parser_registry(spark, sf_dir):
    """Every registered layout applied to its own input by name."""
    inputs = {"chat": T.typed_chat(spark, sf_dir), "mail": T.mails(spark, sf_dir), "web": T.pages(spark, sf_dir)}
    ids = {"chat": "data_hash", "mail": "data_hash", "web": "page_url"}
    parsed = [inputs[name].transform(LAYOUTS[name]).select(
        F.lit(name).alias("layout"), F.col(ids[name]).alias("id"), "position", "url") for name in inputs]
    return parsed[0].unionByName(parsed[1]).unionByName(parsed[2])


@query("union_layouts", E.with_(E.PARTS, E.CHAT, E.MAIL) + """
SELECT 'chat' AS origin, data_hash, position, company, location, experience, lingvo, url FROM (SELECT *, NULL AS lingvo FROM chat)
UNION ALL SELECT 'mail_v' || layout, data_hash, position, company, location, experience, lingvo, url FROM mail""")
def union_layouts(spark, sf_dir):
    chat = T.chat_vacancies(spark, sf_dir).withColumn("origin", F.lit("chat"))
    mail = T.mail_vacancies(spark, sf_dir).withColumn("origin", F.concat(F.lit("mail_v"), F.col("layout")))
    return chat.unionByName(mail, allowMissingColumns=True).select(
        "origin", "data_hash", "position", "company", "location", "experience", "lingvo", "url")


# ----------------------------------------------------------------- completeness

@query("completeness_raw", f"""
SELECT 'chat' AS origin, o_orderkey AS id, NULL::VARCHAR AS audit FROM orders
UNION ALL SELECT 'mail', o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN '1 | 4, html' END FROM orders
UNION ALL SELECT 'statistic', message_id, stat_parsing_error FROM ({STATISTICS})""")
def completeness_raw(spark, sf_dir):
    """Audits of raw chat rows, raw mails (digests come without html here) and statistics."""
    chat = chat_ops.raw_audit(T.chat(spark, sf_dir))
    digest = F.contains("html", F.lit("<p>Digest "))
    mails = landing.mail_audit(T.mails(spark, sf_dir).select(
        "email_uid", "date", F.lit("").alias("text"), F.when(~digest, F.col("html")).alias("html")))
    statistic = extract_chat_statistic(spark, sf_dir)
    row = lambda df, origin, key, audit: df.select(
        F.lit(origin).alias("origin"), F.col(key).alias("id"), F.col(audit).alias("audit"))
    return row(chat, "chat", "message_id", "raw_parsing_error").unionByName(
        row(mails, "mail", "email_uid", "raw_parsing_error")).unionByName(
        row(statistic, "statistic", "message_id", "stat_parsing_error"))


@query("completeness_vacancy", E.with_(E.PARTS, E.CHAT, E.MAIL, E.WEB) + f"""
SELECT 'chat' AS origin, data_hash AS id, NULL::VARCHAR AS parsing_error FROM chat
UNION ALL SELECT 'mail', data_hash, {E.MAIL_ERROR} FROM mail
UNION ALL SELECT 'web', page_url, {E.WEB_ERROR} FROM web""")
def completeness_vacancy(spark, sf_dir):
    row = lambda df, origin, key: df.select(
        F.lit(origin).alias("origin"), F.col(key).alias("id"), "parsing_error")
    return row(T.chat_vacancies(spark, sf_dir), "chat", "data_hash").unionByName(
        row(T.mail_vacancies(spark, sf_dir), "mail", "data_hash")).unionByName(
        row(T.web_vacancies(spark, sf_dir), "web", "page_url"))


@query("quality_report", E.with_(E.PARTS, E.CHAT, E.MAIL, E.WEB).rstrip() + f""",
v AS (SELECT 'chat' AS layout, NULL::VARCHAR AS parsing_error FROM chat
  UNION ALL SELECT 'mail_v' || layout, {E.MAIL_ERROR} FROM mail UNION ALL SELECT 'web', {E.WEB_ERROR} FROM web),
t AS (SELECT layout, count(*) AS n FROM v GROUP BY layout)
SELECT layout, field, count(*) AS missing, round(count(*) / any_value(n), 6) AS share
FROM (SELECT layout, unnest(string_split(regexp_replace(parsing_error, '^\\d+ \\| \\d+, ', ''), ', ')) AS field FROM v)
JOIN t USING (layout) GROUP BY layout, field""")
def quality_report(spark, sf_dir):
    chat = T.chat_vacancies(spark, sf_dir).select(F.lit("chat").alias("layout"), "parsing_error")
    mail = T.mail_vacancies(spark, sf_dir).select(F.concat(F.lit("mail_v"), F.col("layout")).alias("layout"), "parsing_error")
    web = T.web_vacancies(spark, sf_dir).select(F.lit("web").alias("layout"), "parsing_error")
    return analytics.quality_report(chat.unionByName(mail).unionByName(web), "layout")


# ----------------------------------------------------------------------- search

_WORDS = {"position": ["widget"], "company": ["supplier"]}
_FOUND = ["data_hash", "origin", "position", "company", "location", "experience", "salary_from", "tech_stack"]


def _has_word(column: str, word: str) -> str:
    return f"list_contains(regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}]+'), '{word}')"


@query("filter_vacancies", E.with_(E.PARTS, E.CHAT, E.MAIL, E.WEB, E.REPORT) + f"""
SELECT {', '.join(_FOUND)} FROM report WHERE {' AND '.join(_has_word(c, w) for c, some in _WORDS.items() for w in some)}
  AND experience <= 3 AND salary_from >= 1500""")
def filter_vacancies(spark, sf_dir):
    """Search over the vacancies of all sources through the inverted index and the typed table.

    Each call writes a folder of its own, so it leaves the files alone that an earlier result has yet to read.
    """
    path = f"{input_folder(spark, sf_dir)}/search-{uuid.uuid4().hex}"
    rows = T.report(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))
    search.build(rows, path, ["position", "company", "location", "tech_stack"])
    return search.search(spark, path, _WORDS, at_least={"salary_from": 1500}, at_most={"experience": 3}).select(*_FOUND)


@query("label_dims", E.with_(E.PARTS, E.CHAT, E.CHAT_TYPES, E.CHAT_LONG, "names(i, n) AS (VALUES " + E.values(list(S.MESSAGE_TYPES.items())) + ")",
                            "attrs(i, n, t) AS (VALUES " + E.values(S.ATTRS) + ")") + """
SELECT message_id::VARCHAR AS id, 'TELEGRAM' AS source_name, n AS type_name, message_type_id::INTEGER AS id_by_name, NULL AS attr_name, NULL AS attr_type, NULL AS attr_value
FROM chat_types JOIN names ON i = message_type_id
UNION ALL SELECT doc_id::VARCHAR, 'WEB', 'TG_UNKNOWN', 4, NULL, NULL, NULL FROM documents
UNION ALL SELECT data_hash, 'TELEGRAM', NULL, attr_id, n, t, attr_value FROM chat_eav JOIN attrs ON i = attr_id""")
def label_dims(spark, sf_dir):
    """Names of types, sources and attributes by id, and ids by configuration name, where unknown names fall back."""
    types, sources, attrs = (F.broadcast(frame(spark)) for frame in (S.types_frame, S.sources_frame, S.attrs_frame))
    chat = T.typed_chat(spark, sf_dir).select("message_id", "message_type_id", F.lit(S.CHAT).alias("message_source_id"))
    named = chat.join(types, "message_type_id").withColumn("wanted", F.lower("type_name")).select(
        "message_id", "message_source_id", "wanted")
    documents = T.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("message_id"), F.lit(S.WEB).alias("message_source_id"), F.col("source").alias("wanted"))
    fallback, null = S.MESSAGE_TYPES[S.CHAT_UNKNOWN], lambda name: F.lit(None).cast("string").alias(name)
    messages = (named.unionByName(documents).join(sources, "message_source_id")
                .join(types, F.col("wanted") == F.col("config_name"), "left")
                .select(F.col("message_id").cast("string").alias("id"), "source_name", F.coalesce("type_name", F.lit(fallback)).alias("type_name"),
                        F.coalesce("message_type_id", F.lit(S.CHAT_UNKNOWN)).alias("id_by_name"), null("attr_name"), null("attr_type"), null("attr_value")))
    # By configuration name and back: a value's attribute is found by its lower-case name, as a layout gives it.
    names = attrs.select(F.lower("attr_name").alias("config_attr"), F.col("attr_id").alias("id_by_name"), "attr_name", "attr_type")
    values = T.chat_long(spark, sf_dir).join(attrs.select("attr_id", F.lower("attr_name").alias("config_attr")), "attr_id")
    labelled = values.withColumn("message_source_id", F.lit(S.CHAT)).join(sources, "message_source_id").join(F.broadcast(names), "config_attr").select(
        F.col("data_hash").alias("id"), "source_name", null("type_name"), "id_by_name", "attr_name", "attr_type", "attr_value")
    return messages.unionByName(labelled)
