"""Selectors over shredded pages and dictionary handling of skill tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal.functions import dom
from jobsignal.operators import web as web_ops
from jobsignal.plans import datasets as T
from jobsignal.plans import expected as E
from jobsignal.plans.registry import registry
from jobsignal.sources.shred import shred

QUERIES, query = registry()

NAV = (("nav", ()), ("li", ()), ("a", ()))


def _web_nodes(spark, sf_dir):
    return shred(T.pages(spark, sf_dir))


@query("dom_nodes", r"""
WITH cleaned AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'),
    '<script>.*?</script>', '<script></script>', 'gs'), '<style>.*?</style>', '<style></style>', 'gs') AS html FROM pages),
tags AS (SELECT page_id, unnest(regexp_extract_all(html, '<([a-zA-Z][a-zA-Z0-9]*)', 1)) AS tag FROM cleaned)
SELECT lower(tag) AS tag, count(*) AS nodes, count(DISTINCT page_id) AS pages, round(count(*) / (SELECT count(*) FROM tags), 6) AS share
FROM tags GROUP BY ALL""")
def dom_nodes(spark, sf_dir):
    """Elements of all pages by tag: their number, the pages that have them, and their share; counted per page first."""
    per_page = (T.page_nodes(spark, sf_dir).select("page_id", F.explode("nodes.tag").alias("tag")).where("tag NOT LIKE '#%'")
                .groupBy("page_id", "tag").agg(F.count(F.lit(1)).alias("n")))
    per_tag = per_page.groupBy("tag").agg(F.sum("n").alias("nodes"), F.count(F.lit(1)).alias("pages"))
    total = per_tag.agg(F.sum("nodes"))
    return per_tag.select("tag", "nodes", "pages", F.round(F.col("nodes") / total.scalar(), 6).alias("share"))


@query("dom_find", E.with_(E.WEB) + """
SELECT page_url, url AS canonical, CASE WHEN full_card THEN 3 ELSE 2 END::INTEGER AS lists FROM web""")
def dom_find(spark, sf_dir):
    """First node by attribute, and the number of nodes by tag."""
    nodes = F.col("nodes")
    link = dom.attr_of(dom.find(nodes, dom.matches(D.WEB["url"])), "href")
    return _web_nodes(spark, sf_dir).select(
        F.col("url").alias("page_url"), F.split_part(link, F.lit("-"), F.lit(1)).alias("canonical"),
        (F.size(dom.find_all(nodes, dom.tag_is("ul"))) - 1).alias("lists"))


@query("dom_select_css", """
SELECT page_id, len(hrefs)::INTEGER AS links, array_to_string(hrefs, ' ') AS hrefs
FROM (SELECT page_id, regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li><a href="([^"]*)"', 1) AS hrefs
  FROM pages)""")
def dom_select_css(spark, sf_dir):
    found = T.page_nodes(spark, sf_dir).select(
        "page_id", F.transform(dom.select(F.col("nodes"), NAV), lambda f: dom.attr_of(f, "href")).alias("h"))
    return found.select("page_id", F.size("h").alias("links"), F.array_join("h", " ").alias("hrefs"))


def _decoded(sql: str) -> str:
    """SQL text of markup without tags and with the entities the pages use."""
    return ("replace(replace(replace(replace(regexp_replace(" + sql + ", '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), "
            "'&quot;', chr(34)), '&amp;', '&')")


@query("dom_find_next", f"""
SELECT page_id, {_decoded("regexp_extract(html, '</h1><p>(.*?)</?(?:p|article)>', 1, 's')")} AS first_paragraph FROM pages""")
def dom_find_next(spark, sf_dir):
    """First paragraph after the heading, in document order."""
    nodes = F.col("nodes")
    heading = dom.scope(dom.find(nodes, dom.tag_is("h1")))["id"]
    return T.page_nodes(spark, sf_dir).select(
        "page_id", dom.raw_text(dom.find_after(nodes, heading, "p")).alias("first_paragraph"))


@query("dom_children", """
SELECT page_id, len(regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1, 's'), '<li>'))::INTEGER AS items,
  0 AS links FROM pages""")
def dom_children(spark, sf_dir):
    """Direct children of the menu list: its items, but not the links inside them."""
    menu = dom.find(F.col("nodes"), dom.tag_is("ul"))
    return T.page_nodes(spark, sf_dir).select(
        "page_id", F.size(dom.children(menu, "li")).alias("items"), F.size(dom.children(menu, "a")).alias("links"))


@query("dom_text", f"""
SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
  trim({_decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")}) AS heading,
  {_decoded("regexp_extract(html, '<nav>(.*?)</nav>', 1, 's')")} AS menu, trim({_decoded(
      "regexp_extract(html, '<div class=.ad.>(.*?)</div>', 1, 's')")}) AS ad FROM pages""")
def dom_text(spark, sf_dir):
    """Attribute, trimmed text, raw text, and text without a nested node."""
    nodes = F.col("nodes")
    part = lambda tag: dom.find(nodes, dom.tag_is(tag))
    return T.page_nodes(spark, sf_dir).select(
        "page_id", dom.attr_of(part("html"), "lang").alias("lang"), dom.text(part("h1")).alias("heading"),
        dom.raw_text(part("nav")).alias("menu"),
        dom.text_without(dom.find(nodes, dom.matches(D.Selector("div", "class", ("ad",)))), "span").alias("ad"))


@query("dom_heading_contains", E.with_(E.WEB) + "SELECT page_url, 'Skills' AS skills, 'Languages' AS languages FROM web")
def dom_heading_contains(spark, sf_dir):
    nodes = F.col("nodes")
    ids = _web_nodes(spark, sf_dir).select(
        "url", "nodes", dom.heading_id(nodes, "h2", D.SKILLS_HEADINGS).alias("skills_id"),
        dom.heading_id(nodes, "h2", D.LANGUAGE_HEADINGS).alias("languages_id"))
    heading = lambda at: dom.text(dom.find_after(nodes, F.col(at) - 1, "h2"))
    return ids.select(F.col("url").alias("page_url"), heading("skills_id").alias("skills"),
                      heading("languages_id").alias("languages"))


@query("table_to_map", E.with_(E.WEB) + """
SELECT page_url, unnest([p_brand, 'SQL', 'English']) AS k, unnest([p_size || ' years', '', 'B2']) AS v FROM web""")
def table_to_map(spark, sf_dir):
    """Skill tables as key and value; of repeated keys the last row wins."""
    nodes = F.col("nodes")
    entries = dom.last_wins(dom.table_entries(dom.find(nodes, dom.tag_is("table"))))
    return _web_nodes(spark, sf_dir).select(
        F.col("url").alias("page_url"), F.explode(entries).alias("e")).select("page_url", "e.k", "e.v")


def _skill_layers(spark, sf_dir):
    nodes = F.col("nodes")
    second = F.split(dom.text(dom.select_one(nodes, D.WEB["second_skills"])), ", ", -1)
    return _web_nodes(spark, sf_dir).select(
        F.col("url").alias("page_url"), dom.table_entries(dom.find(nodes, dom.tag_is("table"))).alias("skills"),
        F.transform(second, lambda k: F.struct(k.alias("k"), F.lit("").alias("v"))).alias("second"))


@query("merge_maps", E.with_(E.WEB) + """
SELECT DISTINCT page_url, unnest([p_type, 'SQL', p_brand, 'English']) AS k, unnest(['', '', p_size || ' years', 'B2']) AS v FROM web""")
def merge_maps(spark, sf_dir):
    merged = web_ops.merge_entries(F.col("second"), F.col("skills"))
    return _skill_layers(spark, sf_dir).select("page_url", F.explode(merged).alias("e")).select("page_url", "e.k", "e.v")


@query("subtract_keys", E.with_(E.WEB) + """
SELECT page_url, array_to_string(list_sort([p_brand, 'SQL']), ', ') AS left_keys FROM web""")
def subtract_keys(spark, sf_dir):
    kept = web_ops.subtract_keys(F.col("skills"), D.LANGUAGE_KEYS)
    return _skill_layers(spark, sf_dir).select(
        "page_url", F.array_join(F.array_sort(F.transform(kept, lambda e: e["k"])), ", ").alias("left_keys"))


@query("distinct_preserve_order", """
SELECT page_id, array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
    lambda p: list_position(w, p[1]) = p[2]), lambda p: p[1]), ' ') AS words
FROM (SELECT page_id, string_split(regexp_extract(html, '<h1>(.*?)</h1>', 1), ' ') AS w FROM pages)""")
def distinct_preserve_order(spark, sf_dir):
    """First occurrences of the words of a page's heading, in order."""
    heading = F.split(F.regexp_extract("html", "<h1>(.*?)</h1>", 1), " ", -1)
    return T.table(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_distinct(heading), " ").alias("words"))
