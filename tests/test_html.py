"""Shredding, selectors, mail files and page extraction on hand-written input."""

import time
from email.message import EmailMessage

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal.functions import dom
from jobsignal.operators import web
from jobsignal.plans import datasets
from jobsignal.sources import landing
from jobsignal.sources.selecting import Pick, Picks, select, select_any, select_one, select_plain
from jobsignal.sources.shred import _Shredder, shred, shred_one


def tree(html):
    nodes, _ = shred_one(html)
    return [(n[3], n[2], n[1]) for n in nodes if not n[3].startswith("#t")]


def page(spark, html, *columns):
    return shred(spark.createDataFrame([(html,)], "html string"), with_markup=True).select(*columns).first()


def test_implied_ends():
    assert tree("<ul><li>a<li>b</ul>") == [("#root", -1, 5), ("ul", 0, 5), ("li", 1, 3), ("li", 1, 5)]
    assert tree("<p>a<div>b</div>") == [("#root", -1, 4), ("p", 0, 2), ("div", 0, 4)]
    assert [t[0] for t in tree("<table><tr><td>1<td>2<tr><td>3</table>")] == ["#root", "table", "tr", "td", "td", "tr", "td"]
    assert tree("<b><div>x</b>y</div>")[2][1] == 1


def test_markup_is_normalized():
    _, markup = shred_one("<p class=a>x &amp; y&nbsp;z<br>&lt;b&gt;<p>q")
    assert markup == '<p class="a">x &amp; y\xa0z<br/>&lt;b&gt;</p><p>q</p>'


def test_scripts_and_comments_are_no_text(spark):
    row = page(spark, "<div>a<!-- no --><script>no()</script> b </div>", dom.text(F.col("nodes")).alias("t"))
    assert row.t == "ab"


def test_selectors(spark):
    html = ('<aside><div class="x Card card-body"><ul><li>1<ul><li>in</li></ul></li></ul></div></aside>'
            '<div class="card card-body">out</div><p style=" Margin:0 ; color:RED;">s</p><a rel="x canonical y" href="u-1">l</a>')
    nodes = F.col("nodes")
    row = page(
        spark, html,
        F.size(dom.select(nodes, D.WEB["card"])).alias("case_sensitive"),
        F.size(dom.find_all(nodes, dom.matches(D.Selector("div", "class", ("card",))))).alias("by_class"),
        dom.text(dom.find(nodes, dom.matches(D.Selector("p", "style", ("margin:0", "color:red"))))).alias("by_style"),
        F.size(dom.find_all(nodes, dom.matches(D.Selector("p", "style", ("margin:1",))))).alias("no_style"),
        dom.attr_of(dom.find(nodes, dom.matches(D.Selector("a", "rel", ("canonical",)))), "href").alias("href"),
        F.size(dom.children(dom.find(nodes, dom.tag_is("ul")), "li")).alias("direct"),
        F.size(dom.find_all(dom.find(nodes, dom.tag_is("ul")), dom.tag_is("li"))).alias("all"),
        dom.text(dom.find_after(nodes, dom.scope(dom.find(nodes, dom.tag_is("aside")))["id"], "p")).alias("after"),
        dom.text(dom.select_one(dom.find(nodes, dom.tag_is("ul")), (("aside", ()), ("li", ())), nodes)).alias("above"))
    assert (row.case_sensitive, row.by_class, row.by_style, row.no_style, row.href, row.direct, row["all"], row.after,
            row.above) == (0, 2, "s", 0, "u-1", 1, 2, "s", "1in")


TAGS = ["<p>", "</p>", '<div class="a b">', "</div>", "<br>", "<br/>", "<li>", "</li>", "<ul>", "</ul>", "<td>", "</td>", "<tr>", "<table>", "</table>",
        '<a href="u?x=1&amp;y=2" HREF="z">', "</a>", "<P STYLE=\"Color : red\">", "<div/>", "<span class=''>", "<!-- c -->", "<script>a<b</script>",
        "<title>t", "</ p>", "<1>", "a < b", "x > y", "&amp;", "&nbsp", "&#65;", " text ", "\n", "<i title=\"a>b\">", "<b x=1>", "<?php ?>", "<![x]>"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(TAGS), max_size=12))
def test_plain_markup_is_read_like_any_other(pieces):
    """Cutting at the tags gives what the tokenizer of the standard library gives."""
    html = "".join(pieces)
    slow = _Shredder(True)
    slow.feed_plain = lambda _: False
    nodes = slow.read(html)
    assert shred_one(html) == (nodes, "".join(slow.markup))


_ANYWHERE = Picks(
    div=Pick(D.Selector("div", "class", ("a",)), "joined", "id"), below=Pick((("div", ("a",)), ("span", ())), "joined without span", "id"), p=Pick("p", "raw"),
    li=Pick("li", "joined without p"), span=Pick("span", "joined"), void=Pick("br", attr="id"), cell=Pick("td", "joined without br"), template=Pick("template", "raw"))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([
    '<div class="a b" id="1">', "<div>", "</div>", "<span>", '<span id="&amp;2">', "</span>", "<p>", "</p>", "<ul>", "</ul>", "<li>", "</li>", "<table>", "</table>",
    "<tr>", "<td>", "</td>", "<br/>", '<br id="3">', "</br>", "<P />", "<template>", "</template>", " x ", "a &lt; b", "&#xFFFE;", "y>", "\u00a0z\n"]), max_size=40))
def test_plain_pass_finds_what_the_nodes_tell(pieces):
    for with_markup in (False, True):
        html = "".join(pieces)
        assert select_plain(html, _ANYWHERE, with_markup) == select_any(html, _ANYWHERE, with_markup)


def test_plain_pass_is_fast():
    """Hits of plain pages cost less than half of what nodes and hits cost."""
    def seconds(read):
        def once():
            start = time.process_time()
            for i in range(400):
                read(f'<html><body><aside><div class="card card-body"><ul><li><strong>{i}</strong></li></ul><table><tr><td>{i}</td><td>b</td></tr></table></div></aside>'
                     f'<h1><span>x {i}</span></h1></body></html>' * 3, web.PICKS, True)
            return time.process_time() - start
        return min(once() for _ in range(3))

    assert seconds(select_one) < 0.6 * seconds(select_any)


def test_most_markup_is_plain():
    assert _Shredder(False).feed_plain('<div class="a">x &amp; y<br/><P>z</P></div>') and not _Shredder(False).feed_plain("<p class=a>x")


HTML_PIECES = ["<h3>", "</h3>", '<div class="card">', '<div class="Card x">', "</div>", '<a href="u-1">', '<a rel="canonical" href="v">', "</a>", "<span>", "</span>",
               '<p style=" MARGIN:0 ;color:#333">', "</p>", " t ", "\n", "x y", "<ul>", "<li>", "</ul>", '<div class="card card-body">', "<aside>", "</aside>"]
PICKED = {"card": D.Selector("div", "class", ("card",)), "style": D.Selector("p", "style", ("margin:0", "color:#333")), "rel": D.Selector("a", "rel", ("canonical",)),
          "path": (("h3", ()), ("span", ())), "deep": (("aside", ()), ("div", ("card", "card-body")), ("a", ())), "tag": "li", "twice": (("span", ()), ("span", ()))}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(HTML_PIECES), max_size=25))
def test_automaton_against_each_selector_alone(pieces):
    """Hits, texts and subtrees of the automaton equal a plain search of all nodes for each selector."""
    html = "".join(pieces)
    picks = Picks(**{name: Pick(path, "joined", "href") for name, path in PICKED.items()})
    nodes, _ = shred_one(html)

    def passes(node, tag, attr, values, exact):
        value = node[4].get(attr, None if attr else "")
        if node[3] != tag or value is None:
            return False
        items = [i.strip() for i in (value if exact else value.lower()).split(";" if attr == "style" else None)] if attr in ("class", "style") else None
        return all(v in (value if items is None else items) for v in values)

    def plain(path):
        steps = [(path, "", (), True)] if isinstance(path, str) else [(path.tag, path.attr, path.values, False)] if isinstance(path, D.Selector) else [
            (tag, "class" if classes else "", classes, True) for tag, classes in path]
        up = [n for n in nodes if passes(n, *steps[0])]
        for step in steps[1:]:
            up = [n for n in nodes if passes(n, *step) and any(a[0] < n[0] <= a[1] for a in up)]
        return {n[0] for n in up}

    wanted = {name: plain(path) for name, path in PICKED.items()}
    every = sorted(set().union(*wanted.values()))
    rows, _ = select_one(html, picks)
    assert len(rows) == len(every) + 1 and rows[0][:4] == (0, len(every), -1, 0)
    for row, place in zip(rows[1:], every):
        node = nodes[place]
        assert row[3] == sum(1 << i for i, name in enumerate(PICKED) if place in wanted[name])
        assert row[4] == "".join(n[5].strip() for n in nodes[node[0]:node[1] + 1] if n[3] == "#text") and row[5] == node[4].get("href")
        assert row[1] == sum(e <= node[1] for e in every) and row[2] == (every.index(node[2]) + 1 if node[2] in every else -1)


def test_hits_of_a_page(spark):
    picks = Picks(item=Pick("li", "raw"), bare=Pick((("h1", ()), ("span", ())), "joined without span"))
    frame = spark.createDataFrame([("a", "<h1><span> x <span>y</span> z</span></h1><ul><li> 1 <li>2</ul>"), ("b", None), ("c", "<li>q")], "key string, html string")
    got = {r.key: [(n.id, n.last, n.parent, n.hits, n.text) for n in r.nodes] for r in select(frame, picks).collect()}
    assert got["b"] == [(0, 0, -1, 0, None)] and got["c"] == [(0, 1, -1, 0, None), (1, 1, -1, 1, "q")]
    assert got["a"] == [(0, 4, -1, 0, None), (1, 2, -1, 2, "xz"), (2, 2, 1, 2, "y"), (3, 3, -1, 1, " 1 "), (4, 4, -1, 1, "2")]


def test_table_keeps_last_value(spark):
    html = "<table><tr><td>k</td><td>1</td></tr><tr><td>z</td></tr><tr><td>k</td><td>2</td></tr></table>"
    row = page(spark, html, dom.last_wins(dom.table_entries(dom.find(F.col("nodes"), dom.tag_is("table")))).alias("e"))
    assert [(e.k, e.v) for e in row.e] == [("k", "2")]


CARD = """<html><head><link rel="canonical" href="https://djinni.co/jobs/5-dev/"></head><body><h1><span> Dev <span>hot</span></span></h1>
<div class="fs-5"><div class="col">Acme</div></div><div class="job-post__description"><p>Hi &amp; bye</p></div>
<h2>Мовами</h2><table><tr><td>Англійська</td><td>Intermediate</td></tr><tr><td>Ukrainian</td><td>Native</td></tr></table>
<aside><div class="card card-body">
<ul><li><strong>3 years of experience</strong></li><li><strong>$100-200</strong></li><li><strong>Office Work</strong></li>
<li><strong>Україна</strong><small>small</small></li><li><strong>Fluentish</strong></li><li><strong>extra</strong></li></ul>
<ul><li><div class="col"><div class="fw-medium">Go</div></div><table><tr><td>English</td><td>C1</td></tr></table></li></ul>
<ul><li></li><li>Domain: Ads</li><li>Agency</li><li>Kyiv</li><li>more</li></ul></div></aside></body></html>"""


def test_page(spark):
    row = web.extract_page(web.hits_of(spark.createDataFrame([("u", CARD)], "url string, html string"))).first()
    assert row.position == "Dev" and row.company == "Acme" and row.job_desc == "Hi &amp; bye"
    assert row.url == "https://djinni.co/jobs/5" and row.page_url == "u"
    assert (row.salary_from, row.salary_to, row.experience, row.main_tech) == (100, 200, 3, "Go")
    assert row.lingvo == "B1" and row.employment == "Office" and row.candidate_locations == "Ukraine"
    # No skills table: the first table after the canonical link and the card table fill the stack.
    assert row.tech_stack == "English, Англійська"
    assert row.domain == "Ads" and row.company_type == "Outsource/Outstaff Agency" and row.offices is None
    assert row.notes.split("\n") == sorted(
        ["Required knowledge of Ukrainian", "Fluentish", "extra", "small", "Kyiv", "more", "Англійська: Intermediate"])
    assert row.parsing_error is None


def message(**parts):
    m = EmailMessage()
    m["From"], m["Subject"] = "Новини <news@example.com>", "Тема листа"
    if parts.get("date", True):
        m["Date"] = "Tue, 02 Jan 2024 03:04:05 +0200"
    return m


def test_mail_files(spark, tmp_path):
    both = message()
    both.set_content("plain")
    both.add_alternative("<b>html</b>", subtype="html")
    both.add_attachment(b"\x00\x01", maintype="application", subtype="octet-stream", filename="a.bin")
    html = message()
    html.set_content("<i>only</i>", subtype="html")
    text = message(date=False)
    text.set_content("just text")
    twice = message()
    twice.make_mixed()
    for body in ("first", "second"):
        part = EmailMessage()
        part.set_content(body)
        twice.attach(part)
    odd = b"Content-Type: text/plain; charset=no-such\r\nSubject: =?utf-8?B?0KLQtdC80LA=?=\r\n\r\n\xd0\x90\xff"
    for i, m in enumerate([both, html, text, twice]):
        (tmp_path / f"mail-{i}.eml").write_bytes(m.as_bytes())
    (tmp_path / "mail-4.eml").write_bytes(odd)
    rows = {r.email_uid: r for r in landing.read_mail(spark, str(tmp_path)).withColumn(
        "date", F.col("date").cast("string")).collect()}
    assert len(rows) == 5
    assert (rows[0].text.strip(), rows[0].html.strip(), rows[0].n_attachments) == ("plain", "<b>html</b>", 1)
    assert (rows[1].text, rows[1].html.strip()) == ("", "<i>only</i>")
    assert (rows[2].text.strip(), rows[2].date) == ("just text", None)
    assert rows[3].text.strip() == "second"
    assert (rows[4].text, rows[4].subject) == ("А", "Тема")
    assert rows[0].date == "2024-01-02 01:04:05" and rows[0].subject == "Тема листа"
    assert rows[0].sender == "Новини <news@example.com>"


def test_mail_cards_edge(spark):
    """Badge before the experience, salary-only line, and a mail without cards."""
    cell = ('<td style="padding-bottom:24px; box-sizing:border-box"><a style="font-size:18px;font-weight:bold" href="h">P</a>'
            '<p class="djinni-whois-expanded">{}</p></td>')
    html = ["<table><tr>" + cell.format(x) + "</tr></table>" for x in (
        "2 years · Український продукт", '<span style="color:#4cae4c">$5-6</span>', "Kyiv · 4 years of experience")] + ["<p>no</p>"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(html)], "email_uid bigint, html string").withColumn(
        "date", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    rows = {r.email_uid: r for r in datasets.extract_mail(df).collect()}
    assert set(rows) == {0, 1, 2}
    assert (rows[0].experience, rows[0].location, rows[0].quarantine) == (2, None, None)
    assert rows[1].quarantine == "salary_only_line" and rows[1].salary_from == 5
    assert (rows[2].experience, rows[2].location) == (4, "Kyiv")
