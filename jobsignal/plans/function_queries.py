"""Column functions at table scale."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsignal.functions import scalars as X
from jobsignal.operators import mail as mail_ops
from jobsignal.plans import datasets as T
from jobsignal.plans import expected as E
from jobsignal.plans.registry import registry
from jobsignal.sources import fixtures
from jobsignal.sources.landing import parse_mail

QUERIES, query = registry()


@query("fn_to_numeric", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus FROM lineitem)
SELECT l_orderkey, l_linenumber, l_quantity AS whole, l_extendedprice AS point, l_discount AS comma,
  l_quantity::BIGINT::VARCHAR AS rendered, NULL::DOUBLE AS word, NULL::DOUBLE AS grouped FROM l""")
def fn_to_numeric(spark, sf_dir):
    """Numbers rendered with point, comma, blanks, and texts that are no numbers."""
    whole = F.format_string(" %.0f ", "l_quantity")
    point, comma = F.format_string("%.2f", "l_extendedprice"), F.replace(F.format_string("%.2f", "l_discount"), F.lit("."), F.lit(","))
    return T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", X.to_numeric(whole).alias("whole"), X.to_numeric(point).alias("point"),
        X.to_numeric(comma).alias("comma"), X.render_number(X.to_numeric(whole)).alias("rendered"),
        X.to_numeric(F.col("l_returnflag")).alias("word"),
        X.to_numeric(F.concat(F.lit("1,"), F.format_string("%.1f", "l_tax"))).alias("grouped"))


@query("fn_salary_range", E.with_(E.PARTS) + """
SELECT o_orderkey, k, lo::DOUBLE AS lo, hi::DOUBLE AS hi, h::DOUBLE AS one_lo, h::DOUBLE AS one_hi, NULL::DOUBLE AS inner_lo FROM parts""")
def fn_salary_range(spark, sf_dir):
    """Range at the end, single amount at the end, amount inside the text."""
    parts = fixtures.order_parts(spark, sf_dir)
    ranged = F.coalesce(F.concat(F.col("n_name"), F.lit(", $"), F.col("lo"), F.lit("-"), F.col("hi")), F.lit("no pay"))
    bounds = lambda c: X.salary_bounds(c)
    return parts.select("o_orderkey", "k", bounds(ranged).alias("a"),
                        bounds(F.concat(F.lit("pay $"), F.col("h"))).alias("b"),
                        bounds(F.concat(F.lit("$"), F.col("h"), F.lit(" a month"))).alias("c")).select(
        "o_orderkey", "k", "a.lo", "a.hi", F.col("b.lo").alias("one_lo"), F.col("b.hi").alias("one_hi"),
        F.col("c.lo").alias("inner_lo"))


# Another way to the same text: lines are cut apart, trimmed one by one, and the empty ones left out.
@query("fn_html_to_text", r"""
SELECT page_id, array_to_string(list_filter(list_transform(
  string_split(regexp_replace(regexp_replace(replace(html, chr(10), ' '),
    '</?(p|div|li|h[0-9])[^>]*>|<br\s*/?>', chr(10), 'gi'), '<[^>]+>', '', 'g'), chr(10)),
  lambda line: trim(regexp_replace(line, '\s+', ' ', 'g'))), lambda line: line <> ''), chr(10)) AS text
FROM pages""")
def fn_html_to_text(spark, sf_dir):
    return T.table(spark, sf_dir, "pages").select("page_id", X.html_to_text(F.col("html")).alias("text"))


@query("fn_remove_repl", E.with_(E.PARTS) + f"""
SELECT o_orderkey, k, CASE WHEN e = 0 THEN '0' ELSE e::VARCHAR END AS years,
  ['B2', 'B1', 'C1'][h % 3 + 1] AS level, s_name AS company, NULL::VARCHAR AS blank FROM parts""")
def fn_remove_repl(spark, sf_dir):
    """Synonyms and removals on rendered texts; blank text is NULL."""
    c = F.col
    level = F.element_at(F.array(F.lit("Upper-Intermediate"), F.lit("Intermediate"), F.lit("Advanced/Fluent")), (c("h") % 3 + 1).cast("int"))
    return fixtures.order_parts(spark, sf_dir).select(
        "o_orderkey", "k", X.clean(fixtures._experience(c("e")), "experience").alias("years"),
        X.clean(level, "lingvo").alias("level"), X.clean(F.concat(F.lit("at "), c("s_name")), "mail_company").alias("company"),
        X.clean(F.concat(F.lit("  "), F.lpad(F.lit(""), c("k").cast("int"), F.lit(" "))), "lingvo").alias("blank"))


@query("fn_unwrap_tracking_url", E.with_(E.PARTS) + """
SELECT o_orderkey, k, 'https://djinni.co/jobs/' || pk AS url, 'https://djinni.co/jobs/' || pk || '-x/' AS plain FROM parts""")
def fn_unwrap_tracking_url(spark, sf_dir):
    """Links as they land: click-tracking ones, and plain ones that carry no target."""
    return T.links(spark, sf_dir).select(
        "o_orderkey", "k", X.unwrap_tracking_url(F.col("tracked")).alias("url"), X.unwrap_tracking_url(F.col("plain")).alias("plain"))


@query("fn_canonical_url", "SELECT page_id, split_part(url, '-', 1) AS canonical FROM pages")
def fn_canonical_url(spark, sf_dir):
    return T.table(spark, sf_dir, "pages").select("page_id", X.canonical_url(F.col("url")).alias("canonical"))


@query("fn_parse_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || ' 08:20:30' AS mail_date, strftime(o_orderdate, '%Y-%m-%d') AS dotted,
  strftime(o_orderdate, '%Y-%m-%d') AS slashed, NULL::VARCHAR AS bad,
  CASE WHEN day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%Y-%d-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso
FROM orders""")
def fn_parse_date(spark, sf_dir):
    """Mail header dates, day-first dates, and year-first dates read day-first where possible."""
    date = F.col("o_orderdate")
    shape = lambda fmt: F.date_format(date, fmt)
    only_day = lambda c: F.date_format(X.parse_date(c), "yyyy-MM-dd")
    return T.table(spark, sf_dir, "orders").select(
        "o_orderkey", T.day(X.parse_date(F.concat(shape("EEE, d MMM yyyy"), F.lit(" 10:20:30 +0200")))).alias("mail_date"),
        only_day(shape("dd.MM.yyyy HH:mm")).alias("dotted"), only_day(shape("d/M/yyyy")).alias("slashed"),
        only_day(F.col("o_orderpriority")).alias("bad"), only_day(shape("yyyy-MM-dd")).alias("iso"))


@query("fn_vacancy_key", f"SELECT o_orderkey, {E.key('o_orderdate', 'o_orderkey', 'o_orderkey % 3')} AS data_hash FROM orders")
def fn_vacancy_key(spark, sf_dir):
    return T.table(spark, sf_dir, "orders").select(
        "o_orderkey", X.vacancy_key(F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_orderkey") % 3).alias("data_hash"))


@query("fn_strip_markup", "SELECT doc_id, replace(regexp_replace(text, '[*_`]+', '', 'g'), '  ', ' ') AS text FROM documents")
def fn_strip_markup(spark, sf_dir):
    return T.table(spark, sf_dir, "documents").select("doc_id", X.strip_markup(F.col("text")).alias("text"))


@query("fn_decode_header", """
SELECT 'Оголошення' AS topic, lang, source, count(*) AS mails, sum(doc_id)::BIGINT AS numbers, count(DISTINCT 'Оголошення ' || doc_id) AS subjects
FROM documents GROUP BY lang, source""")
def fn_decode_header(spark, sf_dir):
    """Decoded subjects split into topic and number, joined to the documents they announce, by language and source."""
    subject = F.split("subject", " ")
    mails = parse_mail(T.emls(spark, sf_dir)).select("subject", F.get(subject, F.lit(0)).alias("topic"), F.get(subject, F.lit(1)).cast("bigint").alias("doc_id"))
    documents = T.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return mails.join(documents, "doc_id").groupBy("topic", "lang", "source").agg(
        F.count(F.lit(1)).alias("mails"), F.sum("doc_id").alias("numbers"), F.countDistinct("subject").alias("subjects"))


@query("fn_split_middot", E.with_(E.PARTS, E.MAIL) + """
SELECT email_uid, part_no, n AS pieces, n + 1 AS with_blank, n AS without_blank
FROM (SELECT *, CASE WHEN short OR layout = 0 THEN 2 ELSE 4 END::INTEGER AS n FROM mail)""")
def fn_split_middot(spark, sf_dir):
    """Details of the cards of both layouts, split again after a blank piece was put in front."""
    routed = mail_ops.route_template(T.mails(spark, sf_dir))
    cards = [mail_ops.details(mail_ops.hits_of(routed.where(F.col("layout") == i), i), i) for i in (0, 1)]
    again = F.concat(F.lit(" · "), F.array_join("pieces", "·"))
    return cards[0].unionByName(cards[1]).select(
        "email_uid", "part_no", F.size("pieces").alias("pieces"), F.size(X.split_middot(again, True)).alias("with_blank"),
        F.size(X.split_middot(again, False)).alias("without_blank"))


@query("fn_truthy_default", "SELECT event_id, nullif(event_id % 3, 0)::DOUBLE AS kept, nullif(value, 0) AS value FROM events")
def fn_truthy_default(spark, sf_dir):
    return T.table(spark, sf_dir, "events").select(
        "event_id", X.truthy((F.col("event_id") % 3).cast("double")).alias("kept"), X.truthy(F.col("value")).alias("value"))
