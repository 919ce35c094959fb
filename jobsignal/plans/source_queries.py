"""Sources, sinks, dimensions, high-water mark and run counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal import schemas as S
from jobsignal.dictionaries import synonyms_frame
from jobsignal.operators import classify, mail as mail_ops, merge, reshape, web as web_ops
from jobsignal.plans import datasets as T
from jobsignal.plans import expected as E
from jobsignal.plans.registry import registry
from jobsignal.session import input_folder
from jobsignal.sources import bodies, landing
from jobsignal.sources.store import Store

QUERIES, query = registry()


def _scratch(spark, sf_dir: str, name: str) -> str:
    return f"{input_folder(spark, sf_dir)}/{name}"


@query("src_chat_messages", E.with_(E.PARTS, E.CHAT_TEXT, E.CHAT_TYPES) + f"""
SELECT t.message_id, strftime(t.date, {E.DAY}) AS date, t.text, 3 AS message_source_id, message_type_id
FROM chat_text t JOIN chat_types USING (message_id)""")
def src_chat_messages(spark, sf_dir):
    """Messages land as JSON with the text in one of three fields."""
    path = _scratch(spark, sf_dir, "chat_json")
    chat, kind = T.chat(spark, sf_dir), F.col("message_id") % 3
    chat.select("message_id", "date", F.when(kind == 0, F.col("text")).alias("text"),
                F.when(kind == 1, F.col("text")).alias("raw_message"),
                F.when(kind == 2, F.col("text")).alias("message")).write.mode("overwrite").json(path)
    return landing.read_chat(spark, path).select(
        "message_id", T.day("date").alias("date"), "text", "message_source_id", "message_type_id")


@query("src_email_files", f"""
SELECT doc_id AS email_uid, 'News <news@example.com>' AS sender, 'Оголошення ' || doc_id AS subject, text,
  '<div class="card">' || doc_id || '</div>' AS html, 1 AS n_attachments,
  strftime(DATE '2024-01-01' + (doc_id % 300)::INTEGER, '%Y-%m-%d') || ' 08:20:30' AS date FROM documents""")
def src_email_files(spark, sf_dir):
    files = T.emls(spark, sf_dir)
    return landing.parse_mail(files).withColumn("date", T.day("date"))


@query("src_fetch_results", E.with_(E.FETCH) + "SELECT event_id, url, status, html FROM fetched")
def src_fetch_results(spark, sf_dir):
    return T.fetch_results(spark, sf_dir).select("event_id", "url", "status", "html")


@query("src_highwater", """
WITH mark AS (SELECT coalesce(max(o_orderdate), TIMESTAMP '2020-01-01') AS m FROM orders WHERE o_orderstatus = 'F'),
last AS (SELECT coalesce(arg_max(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)), 0) AS id
  FROM orders, mark WHERE o_orderdate < m)
SELECT 'chat' AS source, o_orderkey AS message_id FROM orders, last WHERE o_orderkey > id
UNION ALL SELECT 'mail', o_orderkey FROM orders, mark WHERE o_orderdate >= date_trunc('day', m)""")
def src_highwater(spark, sf_dir):
    """Finished orders play the stored messages, all orders the incoming ones."""
    orders = T.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("message_id"), F.col("o_orderdate").alias("date"), "o_orderstatus")
    stored = orders.where("o_orderstatus = 'F'")
    chat_mark = landing.high_water(stored.withColumn("message_source_id", F.lit(S.CHAT)), S.CHAT)
    mail_mark = landing.high_water(stored.withColumn("message_source_id", F.lit(S.EMAIL)), S.EMAIL)
    source = lambda df, name: df.select(F.lit(name).alias("source"), "message_id")
    return source(landing.new_chat(orders, chat_mark), "chat").unionByName(
        source(landing.new_mail(orders, mail_mark), "mail"))


def dictionary_values(spark, sf_dir):
    """Dictionary name and text of everything that a parser looks up: cards of both mail layouts, and pages."""
    routed = mail_ops.route_template(T.mails(spark, sf_dir))
    cards = [mail_ops.dictionary_texts(mail_ops.hits_of(routed.where(F.col("layout") == i), i), i) for i in (0, 1)]
    pages = web_ops.dictionary_texts(web_ops.hits_of(T.pages(spark, sf_dir)))
    rows = [df.select("dict", "source_text") for df in (*cards, pages)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


_YEARS = "CASE {0} WHEN 0 THEN 'No experience' WHEN 1 THEN '1 year of experience' ELSE {0}::BIGINT || ' years of experience' END"
VALUES = f"""vals AS (SELECT * FROM (
  SELECT unnest(['mail_company', 'experience', 'mail_description']) AS dict,
    unnest(['at ' || company, {_YEARS.format('coalesce(experience, 0)')}, 'Desc ' || h || '… Read more']) AS source_text FROM mail WHERE layout = 0
  UNION ALL SELECT unnest(['experience', 'lingvo', 'employment', 'candidate_locations', 'mail_description', 'mail_subscription']),
    unnest([{_YEARS.format('experience')}, ['Upper-Intermediate', 'Intermediate', 'Fluent'][h % 3 + 1],
      CASE WHEN NOT short THEN ['Office Work', 'Тільки віддалено', 'Part-time'][h % 3 + 1] END,
      CASE WHEN NOT short THEN ['Україна', 'Весь світ', 'NATION_1'][h % 3 + 1] END, 'Desc ' || h, 'Subscription: ' || position]) FROM mail WHERE layout = 1
  UNION ALL SELECT unnest(['lingvo', 'notes', 'notes']), unnest(['Upper-Intermediate', p_brand || ': ' || p_size || ' years', 'German: B1']) FROM web
  UNION ALL SELECT unnest(['experience', 'employment', 'candidate_locations', 'lingvo', 'employment', 'domain', 'company_type', 'offices']),
    unnest([{_YEARS.format('(p_partkey % 6)')}, 'Office Work', 'Україна', 'Upper-Intermediate', 'Part-time', 'Domain: ' || p_type,
      ['Продукт', 'Аутсорс', 'Стартап'][p_partkey % 3 + 1], 'Office: ' || offices]) FROM web WHERE full_card)
  WHERE source_text IS NOT NULL)"""


REMOVALS = "removals(dict, seq, fragment) AS (VALUES " + E.values(
    [(name, i, fragment) for name in D.REMOVALS for i, fragment in enumerate(D.REMOVALS[name])]) + ")"


@query("dim_dictionaries", E.with_(E.PARTS, E.MAIL, E.WEB, VALUES, E.SYNONYMS, REMOVALS) + """
SELECT 'synonym' AS kind, s.dict, s.seq::INTEGER AS seq, s.source_text, s.target, count(v.dict) AS uses
FROM synonyms s LEFT JOIN vals v ON v.dict = s.dict AND v.source_text = s.source_text
GROUP BY ALL
UNION ALL SELECT 'removal', r.dict, r.seq::INTEGER, r.fragment, NULL, count(v.dict)
FROM removals r LEFT JOIN vals v ON v.dict = r.dict AND contains(v.source_text, r.fragment)
GROUP BY ALL""")
def dim_dictionaries(spark, sf_dir):
    """Every synonym and removal with its number of uses in mails and pages; texts are counted before they are compared."""
    used = dictionary_values(spark, sf_dir).groupBy("dict", "source_text").agg(F.count(F.lit(1)).alias("uses"))
    uses = F.coalesce("uses", F.lit(0)).alias("uses")
    synonyms = F.broadcast(synonyms_frame(spark)).join(used, ["dict", "source_text"], "left").select(
        F.lit("synonym").alias("kind"), "dict", "seq", "source_text", "target", uses)
    removals = D.removals_frame(spark).toDF("dict", "seq", "fragment")
    cut = (used.withColumnRenamed("dict", "of").join(
        F.broadcast(removals), (F.col("of") == F.col("dict")) & F.contains("source_text", "fragment"))
        .groupBy("dict", "seq").agg(F.sum("uses").alias("uses")))
    return synonyms.unionByName(F.broadcast(removals).join(cut, ["dict", "seq"], "left").select(
        F.lit("removal").alias("kind"), "dict", "seq", F.col("fragment").alias("source_text"), F.lit(None).cast("string").alias("target"), uses))


@query("dict_normalize", E.with_(E.PARTS, E.MAIL, E.WEB, VALUES, E.SYNONYMS) + """
SELECT v.dict, coalesce(s.target, v.source_text) AS value, count(*) AS n, count(s.target) AS mapped
FROM vals v LEFT JOIN synonyms s ON v.dict = s.dict AND v.source_text = s.source_text
WHERE v.source_text IS NOT NULL GROUP BY ALL""")
def dict_normalize(spark, sf_dir):
    """Whole-text synonyms by a join with the fixed-size dictionary."""
    values = dictionary_values(spark, sf_dir).join(F.broadcast(synonyms_frame(spark)), ["dict", "source_text"], "left")
    return values.groupBy("dict", F.coalesce("target", "source_text").alias("value")).agg(
        F.count(F.lit(1)).alias("n"), F.count("target").alias("mapped"))


@query("dim_enums", E.with_(E.PARTS, E.CHAT, E.CHAT_TYPES, E.CHAT_LONG, "dims(kind, id, name) AS (VALUES " + E.values(
    [("source", i, n) for i, n in S.SOURCES.items()] + [("type", i, n) for i, n in S.MESSAGE_TYPES.items()]
    + [("attr", i, n) for i, n, _ in S.ATTRS]) + ")", """uses AS (
  SELECT 'type' AS kind, message_type_id AS id FROM chat_types
  UNION ALL SELECT 'type', CASE WHEN o_orderkey % 97 = 0 THEN 6 ELSE 5 END FROM orders
  UNION ALL SELECT 'source', 3 FROM orders UNION ALL SELECT 'source', 2 FROM orders UNION ALL SELECT 'source', 1 FROM part
  UNION ALL SELECT 'attr', attr_id FROM chat_eav)""") + """
SELECT d.kind, d.id::INTEGER AS id, d.name, count(u.id) AS uses FROM dims d LEFT JOIN uses u USING (kind, id) GROUP BY ALL""")
def dim_enums(spark, sf_dir):
    """Every enum member with the number of rows that refer to it."""
    types = T.typed_chat(spark, sf_dir).select(F.lit("type").alias("kind"), F.col("message_type_id").alias("id"))
    mail_types = T.mail_signs(spark, sf_dir).select(
        F.lit("type").alias("kind"), classify.mail_type(F.col("nodes")).alias("id"))
    source = lambda df, i: df.select(F.lit("source").alias("kind"), F.lit(i).alias("id"))
    attrs = T.chat_long(spark, sf_dir).select(F.lit("attr").alias("kind"), F.col("attr_id").alias("id"))
    used = types.unionByName(mail_types).unionByName(source(T.chat(spark, sf_dir), S.CHAT)).unionByName(
        source(T.mails(spark, sf_dir), S.EMAIL)).unionByName(source(T.pages(spark, sf_dir), S.WEB)).unionByName(
        attrs).groupBy("kind", "id").agg(F.count(F.lit(1)).alias("uses"))
    dims = (S.sources_frame(spark).select(F.lit("source").alias("kind"), F.col("message_source_id").alias("id"),
                                          F.col("source_name").alias("name"))
            .unionByName(S.types_frame(spark).select(F.lit("type").alias("kind"), F.col("message_type_id").alias("id"),
                                                     F.col("type_name").alias("name")))
            .unionByName(S.attrs_frame(spark).select(F.lit("attr").alias("kind"), F.col("attr_id").alias("id"),
                                                     F.col("attr_name").alias("name"))))
    return dims.join(used, ["kind", "id"], "left").select("kind", "id", "name", F.coalesce("uses", F.lit(0)).alias("uses"))


@query("sink_tables", E.with_(E.PARTS, E.CHAT_TEXT, E.CHAT_TYPES) + f"""
SELECT 'chat-' || message_id AS raw_key, message_id, strftime(t.date, {E.DAY}) AS date, text, 3 AS message_source_id,
  message_type_id FROM chat_text t JOIN chat_types USING (message_id)""")
def sink_tables(spark, sf_dir):
    """Round trip of a table through the store: rows by source and month, texts by content, a second run over one month."""
    store = Store(spark, _scratch(spark, sf_dir, "store"))
    rows = T.typed_chat(spark, sf_dir).select(
        F.concat(F.lit("chat-"), F.col("message_id")).alias("raw_key"), "message_id",
        F.lit(None).cast("bigint").alias("email_uid"), "date", "text", F.lit(None).cast("string").alias("html"),
        F.lit(S.CHAT).alias("message_source_id"), "message_type_id", F.lit(None).cast("string").alias("raw_parsing_error"))
    store.append("bodies", bodies.new_bodies(store.read("bodies"), store.stage(
        "_given", bodies.bodies_of(rows, "text").withColumn("_place", F.monotonically_increasing_id()))))
    stored = bodies.keyed(rows, text="text_key", html="html_key")
    store.stage("raw_messages", stored.withColumn("message_type_id", F.lit(S.CHAT_UNKNOWN)))
    store.commit()
    for month in (F.month("date") <= 6, F.month("date") > 6):
        batch = stored.where(month)
        store.merge("raw_messages", ["raw_key"], batch, lambda old, batch=batch: merge.upsert(
            old, batch, ["raw_key"], ["message_type_id"], ["date"], collapsed=True))
        store.commit()
    read = bodies.with_body(store.read("raw_messages"), store.read("bodies"), "text_key", "text")
    return read.select(
        "raw_key", "message_id", T.day("date").alias("date"), "text", "message_source_id", "message_type_id")


@query("sink_report_export", E.with_(E.PARTS, E.CHAT, E.MAIL, E.WEB, E.REPORT) + f"""
SELECT data_hash, origin, year(date)::INTEGER AS year, {', '.join(E.REPORT_COLUMNS)} FROM report""")
def sink_report_export(spark, sf_dir):
    """Flat report over chat, mails and pages as CSV, one folder per origin and year, read back with its header."""
    path = _scratch(spark, sf_dir, "report_csv")
    rows = T.report(spark, sf_dir).withColumn("year", F.year("date")).select("data_hash", *E.REPORT_COLUMNS, "origin", "year")
    rows.hint("rebalance", "origin", "year").write.mode("overwrite").partitionBy("origin", "year").option(
        "header", True).option("quoteAll", True).option("escape", '"').csv(path)
    schema = ", ".join(f"{c} string" for c in ["data_hash", *E.REPORT_COLUMNS, "origin"]) + ", year int"
    back = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return reshape.typed(back)


@query("run_counters", E.with_(E.PARTS, E.CHAT, E.CHAT_TYPES, """
old AS (SELECT * FROM chat_types WHERE date < TIMESTAMP '1997-01-01'), oldv AS (SELECT * FROM chat WHERE date < TIMESTAMP '1997-01-01'),
c AS (SELECT 'TG_RAW' AS kind, count(*) AS total, count(*) FILTER (message_id NOT IN (SELECT message_id FROM old)) AS added FROM chat_types
  UNION ALL SELECT 'TG_STATISTIC', count(*), count(*) FILTER (message_id NOT IN (SELECT message_id FROM old)) FROM chat_types WHERE message_type_id = 2
  UNION ALL SELECT 'TG_SERVICE', count(*), count(*) FILTER (message_id NOT IN (SELECT message_id FROM old)) FROM chat_types WHERE message_type_id = 3
  UNION ALL SELECT 'TG_VACANCY', count(*), count(*) FILTER (data_hash NOT IN (SELECT data_hash FROM oldv)) FROM chat
  UNION ALL SELECT 'TG_URL', count(*), count(DISTINCT url) FILTER (url NOT IN (SELECT url FROM oldv)) FROM chat)""") + """
SELECT kind || ' added' AS label, added AS n FROM c WHERE added > 0
UNION ALL SELECT kind || ' updated', total - added FROM c WHERE total - added > 0""")
def run_counters(spark, sf_dir):
    """Counters of a full re-read over a store that holds the messages before 1997."""
    chat, parts = T.typed_chat(spark, sf_dir), T.chat_vacancies(spark, sf_dir)
    old = F.col("date") < F.lit("1997-01-01").cast("timestamp_ntz")
    kinds = [("TG_RAW", chat, ["message_id"]), ("TG_STATISTIC", chat.where("message_type_id = 2"), ["message_id"]),
             ("TG_SERVICE", chat.where("message_type_id = 3"), ["message_id"]),
             ("TG_VACANCY", parts, ["data_hash"]), ("TG_URL", parts, ["url"])]
    counted = [merge.count_outcomes(kind, df, keys, df.where(old)) for kind, df, keys in kinds]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result.orderBy("label")
