"""SQL building blocks for the expected results, computed from the source columns only."""

from __future__ import annotations

from jobsignal import dictionaries as D


def text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    """Body of a VALUES list."""
    cell = lambda v: "NULL" if v is None else text(v) if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# One row per vacancy part of an order.
PARTS = """parts AS (
  SELECT o_orderkey, o_orderdate, k, h, pk, p_name, s_name, n_name, replace(n_name, '_', '') AS place, h % 6 AS e,
    CASE WHEN h % 5 <> 0 THEN 1000 + 100 * (h % 20) END AS lo,
    CASE WHEN h % 5 <> 0 THEN 1500 + 100 * (h % 20) + 50 * (h % 7) END AS hi
  FROM (SELECT o_orderkey, o_orderdate, k, o_orderkey * 3 + k AS h,
          (o_orderkey * 7 + k * 13) % (SELECT count(*) FROM part) AS pk,
          (o_orderkey + k) % (SELECT count(*) FROM supplier) AS sk
        FROM (SELECT o_orderkey, o_orderdate, unnest(range(0, o_orderkey % 3 + 1)) AS k FROM orders))
  JOIN part ON p_partkey = pk JOIN supplier ON s_suppkey = sk JOIN nation ON n_nationkey = s_nationkey)"""

DAY = "'%Y-%m-%d %H:%M:%S'"
EXPERIENCE = ("CASE e WHEN 0 THEN 'No experience' WHEN 1 THEN '1 year of experience' "
              "ELSE e || ' years of experience' END")


def key(date: str, ident: str, part: str) -> str:
    return f"""md5('["' || strftime({date}, '%d/%m/%Y %H:%M:%S') || '", ' || {ident} || ', ' || {part} || ']')"""


# Chat vacancies as they have to come out of the extraction.
CHAT = f"""chat AS (
  SELECT o_orderkey AS message_id, o_orderdate AS date, k::INTEGER AS part_no,
    {key('o_orderdate', 'o_orderkey', 'k')} AS data_hash,
    p_name AS position, s_name AS company, place AS location, e::DOUBLE AS experience,
    lo::DOUBLE AS salary_from, hi::DOUBLE AS salary_to, 'Line A ' || k || chr(10) || 'Line B' AS job_desc_prev,
    'https://djinni.co/jobs/' || pk || '-x/' AS url, p_name AS subscription, h, pk, n_name, s_name, p_name
  FROM parts WHERE o_orderkey % 10 <= 6)"""

# Type of every chat message.
CHAT_TYPES = """chat_types AS (
  SELECT o_orderkey AS message_id, o_orderdate AS date,
    CASE WHEN o_orderkey % 10 <= 6 THEN 1 WHEN o_orderkey % 10 = 7 THEN 2 WHEN o_orderkey % 10 = 8 THEN 3
      WHEN o_orderkey % 20 = 9 THEN 4 ELSE 3 END AS message_type_id FROM orders)"""

# Full text of every chat message.
CHAT_TEXT = f"""chat_text AS (
  SELECT o_orderkey AS message_id, o_orderdate AS date,
    CASE WHEN o_orderkey % 10 <= 6 THEN v
      WHEN o_orderkey % 10 = 7 THEN 'Statistics on Djinni for the query' || chr(10) || 'Jobs for 30 days: '
        || o_orderkey % 500 || chr(10) || 'Candidates online: ' || o_orderkey % 900 || chr(10) || 'Salary range: $'
        || 1000 + o_orderkey % 100 || '-' || 2000 + o_orderkey % 100 || chr(10) || 'Applications per job posting: '
        || o_orderkey % 40 || '.5' || CASE WHEN o_orderkey % 50 <> 7 THEN chr(10) || 'Jobs: ' || o_orderkey % 70
        ELSE '' END || chr(10) || 'Candidates: ' || o_orderkey % 80
      WHEN o_orderkey % 30 = 8 THEN '/help' WHEN o_orderkey % 30 = 18 THEN 'ok'
      WHEN o_orderkey % 30 = 28 THEN 'Active Subscriptions: ' || o_orderkey
      WHEN o_orderkey % 20 = 9 THEN 'hello ' || o_orderkey || ' there'
      ELSE '/pause __Subscription:__ ' || o_orderkey END AS text
  FROM (SELECT o_orderkey, o_orderdate, string_agg('**' || p_name || '** в ' || s_name || chr(10) || n_name || ', '
      || {EXPERIENCE} || coalesce(', $' || lo || '-' || hi, '') || chr(10) || chr(10) || 'Line A ' || k || chr(10)
      || 'Line B' || chr(10) || chr(10) || 'https://djinni.co/jobs/' || pk || '-x/' || chr(10)
      || '__Subscription:__ "' || p_name || '"', chr(10) || chr(10) ORDER BY k) AS v
    FROM parts GROUP BY o_orderkey, o_orderdate))"""

# Mail cards; orders divisible by 97 carry none.
MAIL = f"""mail_dates AS (
  SELECT o_orderkey AS email_uid, (o_orderkey % 2)::INTEGER AS layout,
    CASE o_orderkey WHEN 2 THEN TIMESTAMP '2025-01-24 00:00:00' WHEN 1 THEN TIMESTAMP '2025-01-24 00:00:01'
      ELSE (CASE WHEN o_orderkey % 2 = 0 THEN DATE '2024-06-01' ELSE DATE '2025-02-01' END
            + (o_orderkey % 200)::INTEGER)::TIMESTAMP END AS date FROM orders),
mail AS (
  SELECT email_uid, date, layout, k::INTEGER AS part_no, {key('date', 'email_uid', 'k')} AS data_hash,
    layout = 1 AND email_uid % 101 = 5 AND k = 0 AS short,
    p_name AS position, s_name AS company, 'https://djinni.co/jobs/' || pk AS url,
    CASE WHEN layout = 0 THEN n_name END AS location,
    CASE WHEN layout = 1 OR e > 0 THEN e::DOUBLE END AS experience,
    CASE WHEN layout = 1 THEN ['B2', 'B1', 'C1'][h % 3 + 1] END AS lingvo,
    CASE WHEN layout = 1 AND NOT short THEN ['Office', 'Full Remote', 'Part-time'][h % 3 + 1] END AS employment,
    CASE WHEN layout = 1 AND NOT short THEN ['Ukraine', 'Worldwide', 'NATION_1'][h % 3 + 1] END AS candidate_locations,
    lo::DOUBLE AS salary_from, hi::DOUBLE AS salary_to, 'Desc ' || h AS job_desc_prev,
    CASE WHEN layout = 1 THEN p_name END AS subscription, h
  FROM mail_dates JOIN parts ON o_orderkey = email_uid WHERE email_uid % 97 <> 0)"""
MAIL_FIELDS = ("position, location, experience, lingvo, salary_from, salary_to, job_desc_prev, company, employment, "
               "candidate_locations, subscription, url")
MAIL_ERROR = """CASE WHEN layout = 0 AND experience IS NULL THEN 'experience'
    WHEN short AND salary_from IS NULL THEN '2 | 7, employment, candidate_locations'
    WHEN short THEN '2 | 9, employment, candidate_locations' END"""

# Vacancy pages: full = job card with its three lists, linked = canonical link present.
WEB = """web AS (
  SELECT 'https://djinni.co/jobs/' || p_partkey AS page_url, p_partkey, p_partkey % 11 <> 0 AS full_card,
    p_partkey % 13 <> 0 AS linked, p_name AS position, s_name AS company,
    'About ' || p_partkey || chr(10) || 'a' || chr(10) || 'b' AS job_desc,
    CASE WHEN linked THEN 'https://djinni.co/jobs/' || p_partkey END AS url,
    array_to_string(list_sort(list_distinct([p_brand, p_type, 'SQL'])), ', ') AS tech_stack, 'B2' AS lingvo,
    p_brand || ': ' || p_size || ' years' || chr(10) || 'German: B1'
      || CASE WHEN full_card THEN chr(10) || 'exp note' ELSE '' END AS notes,
    CASE WHEN full_card THEN p_brand END AS main_tech, CASE WHEN full_card THEN (p_partkey % 6)::DOUBLE END AS experience,
    CASE WHEN full_card AND p_partkey % 5 <> 0 THEN (1000 + 100 * (p_partkey % 20))::DOUBLE END AS salary_from,
    CASE WHEN full_card AND p_partkey % 5 <> 0 THEN (1500 + 100 * (p_partkey % 20) + 50 * (p_partkey % 7))::DOUBLE END
      AS salary_to,
    CASE WHEN full_card THEN 'Office, Part-time' END AS employment, CASE WHEN full_card THEN 'Ukraine' END
      AS candidate_locations, CASE WHEN full_card THEN p_type END AS domain,
    CASE WHEN full_card THEN ['Product', 'Outsource', 'Startup'][p_partkey % 3 + 1] END AS company_type,
    CASE WHEN full_card THEN n_name END AS offices, p_brand, p_type, p_size
  FROM part JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier)
  JOIN nation ON n_nationkey = s_nationkey)"""
WEB_FIELDS = ("position, experience, main_tech, tech_stack, lingvo, salary_from, salary_to, company, company_type, "
              "domain, offices, employment, candidate_locations, job_desc, notes")
WEB_ERROR = """CASE WHEN full_card AND linked THEN NULL WHEN full_card THEN 'url'
    WHEN linked THEN '6 | 12, experience, candidate_locations, employment, domain, company_type, main_tech'
    ELSE '7 | 12, url, experience, candidate_locations, employment, domain, company_type, main_tech' END"""

# Fetch attempts and the newest one per url.
FETCH = """fetched AS (
  SELECT 'https://djinni.co/jobs/' || user_id AS url, user_id, ts, event_id,
    CASE event_type WHEN 'purchase' THEN 404 WHEN 'error' THEN 0 ELSE 200 END::INTEGER AS status,
    CASE event_type WHEN 'purchase' THEN 'Error for URL https://djinni.co/jobs/' || user_id || ': 404'
      WHEN 'error' THEN 'Connection error/timeout: X' WHEN 'signup' THEN 'Your IP address 1.2.3.4 has been blocked'
      ELSE 'page ' || event_id END AS html FROM events),
newest AS (
  SELECT url, user_id, ts, event_id, html, CASE WHEN contains(html, 'has been blocked') THEN 429 ELSE status END AS status
  FROM fetched QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts DESC, event_id DESC) = 1)"""

# Report over all sources: a page adds to the newest vacancy of each origin that has its url, and its numbers win.
_TEXTS = ["position", "company", "location", "job_desc_prev", "subscription", "lingvo", "employment", "candidate_locations"]
_PAGE_TEXTS = ["main_tech", "tech_stack", "company_type", "domain", "offices", "job_desc", "notes"]
_PAGE = {"position", "company", "lingvo", "employment", "candidate_locations"}
REPORT_COLUMNS = [*_TEXTS, *_PAGE_TEXTS, "experience", "salary_from", "salary_to"]
REPORT = f"""vac AS (
  SELECT 'chat' AS origin, data_hash, date, message_id AS id, part_no, 'https://djinni.co/jobs/' || pk AS page_url, position, company, location,
    job_desc_prev, subscription, NULL AS lingvo, NULL AS employment, NULL AS candidate_locations, experience, salary_from, salary_to FROM chat
  UNION ALL SELECT 'mail', data_hash, date, email_uid, part_no, url, position, company, location, job_desc_prev, subscription, lingvo, employment,
    candidate_locations, experience, salary_from, salary_to FROM mail WHERE NOT short),
pages_of AS (SELECT v.data_hash AS dh, web.* FROM (SELECT * FROM vac
    QUALIFY row_number() OVER (PARTITION BY origin, page_url ORDER BY date DESC, id DESC, part_no DESC) = 1) v JOIN web USING (page_url) WHERE linked),
report AS (SELECT v.data_hash, v.origin, v.date,
    {', '.join(f"nullif(array_to_string(list_sort(list_distinct([v.{c}, w.{c}])), ', '), '') AS {c}" if c in _PAGE else f"v.{c}" for c in _TEXTS)},
    {', '.join(f"w.{c}" for c in _PAGE_TEXTS)}, coalesce(w.experience, v.experience) AS experience,
    coalesce(w.salary_from, v.salary_from) AS salary_from, coalesce(w.salary_to, v.salary_to) AS salary_to
  FROM vac v LEFT JOIN pages_of w ON w.dh = v.data_hash)"""

# Attributes of chat vacancies in the long form.
CHAT_LONG = """chat_long AS (
  SELECT data_hash, date, message_id, part_no, unnest([1, 2, 3, 7, 8, 9, 10, 16])::INTEGER AS attr_id,
    unnest([position, location, experience::BIGINT::VARCHAR, salary_from::BIGINT::VARCHAR,
      salary_to::BIGINT::VARCHAR, job_desc_prev, company, subscription]) AS attr_value FROM chat),
chat_eav AS (SELECT * FROM chat_long WHERE attr_value IS NOT NULL)"""

SYNONYMS = "synonyms(dict, seq, source_text, target) AS (VALUES " + values(
    [(name, i, source, target) for name in D.SYNONYMS for i, (source, target) in enumerate(D.synonym_pairs(name))]) + ")"
