"""Aggregations, trends, ordering and top-k over extracted vacancies."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsignal.operators import analytics, chat as chat_ops, reshape, sketches
from jobsignal.plans import datasets as T
from jobsignal.plans import expected as E
from jobsignal.plans.registry import registry
from jobsignal.session import input_folder
from jobsignal.sources import landing

QUERIES, query = registry()


@query("salary_stats", E.with_(E.PARTS, E.CHAT) + """
SELECT location, count(*) AS n, min(salary_from) AS min_salary, max(salary_to) AS max_salary,
  round(avg(salary_from), 2) AS avg_from, round(avg(salary_to), 2) AS avg_to,
  round(quantile_cont(salary_from, 0.25), 2) AS p25, round(quantile_cont(salary_from, 0.5), 2) AS p50,
  round(quantile_cont(salary_from, 0.75), 2) AS p75
FROM chat WHERE salary_from IS NOT NULL GROUP BY location""")
def salary_stats(spark, sf_dir):
    """Raw chat messages to salary statistics by location."""
    return analytics.salary_stats(T.chat_vacancies(spark, sf_dir).where("quarantine IS NULL"), ["location"])


@query("tech_demand", E.with_(E.WEB) + """
SELECT tech, count(*) AS vacancies, round(count(*) / (SELECT count(*) FROM web), 6) AS share
FROM (SELECT unnest(list_distinct([p_brand, p_type, 'SQL'])) AS tech FROM web) GROUP BY tech""")
def tech_demand(spark, sf_dir):
    return analytics.tech_demand(T.web_vacancies(spark, sf_dir)).orderBy(F.desc("vacancies"), "tech")


@query("location_mix", E.with_(E.PARTS, E.MAIL, E.WEB) + """
SELECT place, n, remote, office, relocation, round(remote / n, 6) AS remote_share, round(office / n, 6) AS office_share FROM (
  SELECT coalesce(candidate_locations, 'unknown') AS place, count(*) AS n,
    count(*) FILTER (contains(employment, 'Remote')) AS remote, count(*) FILTER (contains(employment, 'Office')) AS office,
    count(*) FILTER (offices IS NOT NULL AND NOT contains(coalesce(employment, ''), 'Remote')) AS relocation
  FROM (SELECT candidate_locations, employment, offices FROM web
    UNION ALL SELECT candidate_locations, employment, NULL FROM mail) GROUP BY place)""")
def location_mix(spark, sf_dir):
    columns = ["candidate_locations", "employment", "offices"]
    web = T.web_vacancies(spark, sf_dir).select(*columns)
    mail = T.mail_vacancies(spark, sf_dir).select("candidate_locations", "employment", F.lit(None).cast("string").alias("offices"))
    return analytics.location_mix(web.unionByName(mail))


@query("company_type_mix", E.with_(E.WEB) + """
SELECT coalesce(company_type, 'unknown') AS company_type, coalesce(domain, 'unknown') AS domain, count(*) AS n,
  count(salary_from) AS paid, round(avg(salary_from), 2) AS avg_from, max(salary_to) AS max_to FROM web GROUP BY 1, 2""")
def company_type_mix(spark, sf_dir):
    return analytics.company_type_mix(T.web_vacancies(spark, sf_dir))


@query("market_cube", E.with_(E.WEB) + """
SELECT company_type, employment, candidate_locations, grouping_id(company_type, employment, candidate_locations) AS level,
  count(*) AS n, round(avg(salary_from), 2) AS avg_from
FROM (SELECT coalesce(company_type, 'unknown') AS company_type, coalesce(employment, 'unknown') AS employment,
    coalesce(candidate_locations, 'unknown') AS candidate_locations, salary_from FROM web)
GROUP BY CUBE (company_type, employment, candidate_locations)""")
def market_cube(spark, sf_dir):
    return analytics.market_cube(T.web_vacancies(spark, sf_dir), ["company_type", "employment", "candidate_locations"])


PERIODS = """SELECT strftime(date_trunc('{unit}', date), '%Y-%m-%d') AS period, count(*) AS postings,
  count(DISTINCT split_part(url, '-', 1)) AS openings, round(avg(salary_from), 2) AS avg_from FROM chat GROUP BY 1"""


@query("market_dynamics", E.with_(E.PARTS, E.CHAT) + f"""
SELECT 'week' AS unit, * FROM ({PERIODS.format(unit='week')}) UNION ALL SELECT 'month', * FROM ({PERIODS.format(unit='month')})
UNION ALL SELECT 'season', month(date)::VARCHAR, count(*), NULL, NULL FROM chat GROUP BY 2""")
def market_dynamics(spark, sf_dir):
    """Postings, openings and pay per week and month, and postings per calendar month."""
    return analytics.market_calendar(T.chat_vacancies(spark, sf_dir))


@query("dynamics_delta", E.with_(E.PARTS, E.CHAT) + """
SELECT period, postings, postings - lag(postings) OVER w AS delta,
  round(avg(postings) OVER (ORDER BY period ROWS BETWEEN 3 PRECEDING AND CURRENT ROW), 4) AS moving_avg
FROM (SELECT strftime(date_trunc('month', date), '%Y-%m-%d') AS period, count(*) AS postings FROM chat GROUP BY 1)
WINDOW w AS (ORDER BY period)""")
def dynamics_delta(spark, sf_dir):
    return analytics.dynamics_delta(analytics.market_dynamics(T.chat_vacancies(spark, sf_dir), "month"), "postings")


@query("statistic_series", """
SELECT strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') AS period, count(*) AS reports,
  round(avg(o_orderkey % 500), 4) AS vacancies_in_30d, round(avg(o_orderkey % 900), 4) AS candidates_online,
  round(avg(1000 + o_orderkey % 100), 4) AS min_salary, round(avg(2000 + o_orderkey % 100), 4) AS max_salary,
  round(avg(o_orderkey % 40 + 0.5::DOUBLE), 4) AS responses_to_vacancies,
  round(avg(CASE WHEN o_orderkey % 50 <> 7 THEN o_orderkey % 70 END), 4) AS vacancies_per_week,
  round(avg(o_orderkey % 80), 4) AS candidates_per_week
FROM orders WHERE o_orderkey % 10 = 7 GROUP BY 1""")
def statistic_series(spark, sf_dir):
    rows = T.typed_chat(spark, sf_dir).where("message_type_id = 2")
    return analytics.statistic_series(chat_ops.extract_statistics(rows))


@query("eav_to_wide", E.with_(E.PARTS, E.CHAT) + """
SELECT data_hash, position, location, experience::BIGINT::VARCHAR AS experience, salary_from::BIGINT::VARCHAR AS salary_from,
  salary_to::BIGINT::VARCHAR AS salary_to, job_desc_prev, company, subscription, NULL::VARCHAR AS main_tech FROM chat""")
def eav_to_wide(spark, sf_dir):
    return reshape.to_wide(T.chat_long(spark, sf_dir)).select(
        "data_hash", "position", "location", "experience", "salary_from", "salary_to", "job_desc_prev", "company",
        "subscription", "main_tech")


@query("vac_attr", E.with_(E.PARTS, E.CHAT) + """
SELECT data_hash, position AS attr_1, experience::BIGINT::VARCHAR AS attr_3, salary_to::BIGINT::VARCHAR AS attr_8 FROM chat""")
def vac_attr(spark, sf_dir):
    attrs = reshape.vac_attr(T.chat_long(spark, sf_dir))
    return attrs.select("data_hash", *[F.array_join(F.try_element_at("attrs", F.lit(i)), ", ").alias(f"attr_{i}") for i in (1, 3, 8)])


@query("collect_distinct_join", """
SELECT l_suppkey, string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand) AS joined
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey""")
def collect_distinct_join(spark, sf_dir):
    lines = T.table(spark, sf_dir, "lineitem").join(
        T.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey", "p_brand")
    return reshape.collect_distinct_join(lines, ["l_suppkey"], "p_brand", ", ")


@query("agg_max_date", """
SELECT o_orderpriority AS source, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_date FROM orders GROUP BY 1""")
def agg_max_date(spark, sf_dir):
    return T.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("source")).agg(
        T.day(F.max("o_orderdate")).alias("last_date"))


@query("agg_counters", "SELECT event_type AS label, count(*) AS n FROM events GROUP BY 1")
def agg_counters(spark, sf_dir):
    return T.table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("label")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("label")


@query("order_by_message_date", E.with_(E.PARTS, E.CHAT) + """
SELECT url, data_hash FROM chat QUALIFY row_number() OVER (PARTITION BY url ORDER BY date DESC, message_id DESC, part_no DESC) = 1""")
def order_by_message_date(spark, sf_dir):
    """The vacancy a url points to after all messages were taken in date order."""
    order = F.struct("date", "message_id", "part_no")
    return T.chat_vacancies(spark, sf_dir).groupBy("url").agg(F.max_by("data_hash", order).alias("data_hash"))


@query("last_before_date", """
SELECT o_orderkey AS message_id, o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def last_before_date(spark, sf_dir):
    orders = T.table(spark, sf_dir, "orders").withColumnsRenamed({"o_orderkey": "message_id", "o_orderdate": "date"})
    return landing.last_before_date(orders, "1998-01-01", "message_id").select("message_id", "o_totalprice")


@query("top_k_values", """
SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
ORDER BY n DESC, p_brand LIMIT 5""")
def top_k_values(spark, sf_dir):
    lines = T.table(spark, sf_dir, "lineitem").join(
        T.table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return analytics.top_k(lines, "p_brand", 5)


def _daily(spark, sf_dir, name, rows):
    """A table of daily rows, laid out by year and read back; a day's run would append its own."""
    path = f"{input_folder(spark, sf_dir)}/daily/{name}"
    rows.withColumn("year", F.year("day")).hint("rebalance", "year").write.mode("overwrite").partitionBy("year").parquet(path)
    return spark.read.parquet(path)


@query("top_k_stored", E.with_(E.PARTS, E.CHAT, E.MAIL, E.WEB, E.REPORT) + """
SELECT company AS item, count(*) AS n FROM vac WHERE date >= TIMESTAMP '1996-01-01' AND date < TIMESTAMP '2025-03-01' GROUP BY company
ORDER BY n DESC, item LIMIT 10""")
def top_k_stored(spark, sf_dir):
    """Companies with the most vacancies of a period, from stored daily summaries."""
    rows = T.vacancies(spark, sf_dir).select(F.to_date("date").alias("day"), "company")
    period = F.col("year").between(1996, 2025) & (F.col("day") < F.lit("2025-03-01").cast("date"))
    stored = [_daily(spark, sf_dir, name, build(rows, "day", "company")).where(period)
              for name, build in (("items", sketches.daily_items), ("counts", sketches.daily_counts))]
    return sketches.top_items(*stored, 10)


@query("openings_stored", E.with_(E.PARTS, E.CHAT, E.MAIL, E.WEB, E.REPORT).rstrip() + """,
v AS (SELECT DISTINCT year(date)::VARCHAR AS year, origin, page_url FROM vac)
SELECT year, count(DISTINCT page_url) AS openings, true AS close FROM v GROUP BY year
UNION ALL SELECT 'chat and mail', count(*), true FROM (SELECT page_url FROM v GROUP BY page_url HAVING count(DISTINCT origin) = 2)""")
def openings_stored(spark, sf_dir):
    """Distinct openings per year and those that chat and mails share: exact, and whether the estimate from sketches
    stored per day and origin is within four standard errors."""
    rows = T.vacancies(spark, sf_dir).select("origin", F.to_date("date").alias("day"), F.col("canonical_url").alias("opening"))
    stored = _daily(spark, sf_dir, "openings", sketches.opening_sketches(rows, ["origin", "day"], "opening"))
    by_year = sketches.distinct_openings(stored.select(F.col("year").cast("string").alias("year"), "sketch"), ["year"])
    exact = rows.select(F.year("day").cast("string").alias("year"), "opening").distinct().groupBy("year").agg(F.count(F.lit(1)).alias("exact"))
    years = by_year.join(exact, "year").select("year", F.col("exact").alias("openings"), F.col("openings").alias("estimate"))
    by_origin = sketches.distinct_openings(stored.select("origin", "sketch"), ["origin"])
    one = by_origin.agg(*[F.max(F.when(F.col("origin") == o, F.col("sketch"))).alias(o) for o in ("chat", "mail")])
    both = rows.select("origin", "opening").distinct().groupBy("opening").agg(F.count(F.lit(1)).alias("n")).where("n = 2").agg(F.count(F.lit(1)).alias("openings"))
    shared = one.select(F.lit("chat and mail").alias("year"), both.scalar().alias("openings"),
                        sketches.shared_openings(F.col("chat"), F.col("mail")).alias("estimate"))
    error = 4 / 2 ** (sketches.LOG_ENTRIES / 2)
    return years.unionByName(shared).select("year", "openings", (F.abs(F.col("estimate") - F.col("openings")) <= error * F.greatest("openings", F.lit(1))).alias("close"))
