"""Edge values of the column functions and of message splitting."""

import base64
import json
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobsignal.functions import scalars as X
from jobsignal.operators import chat, classify
from jobsignal.operators.analytics import grouped_percentiles


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


def test_salary(spark):
    cases = {
        "$2000-3500": (2000, 3500), "Kyiv, 3 years of experience, $2000-3500": (2000, 3500), "$2000-$3500": (3500, 3500),
        "$2000 - 3500": (3500, 3500), "1000 -2000": (-2000, -2000), "$1,500-2,500": (1.5, 2.5),
        "1.234.567": (234.567, 234.567), "$100–200": (200, 200), "$3000\n": (None, None), "up to 4k": (None, None),
        "Remote": (None, None), "": (None, None), "$0-500": (0, 500), "a-5": (-5, -5), "x +7": (7, 7), "1--2": (1, -2),
    }
    assert [tuple(r) for r in column(spark, list(cases), X.salary_bounds)] == list(cases.values())


def test_salary_texts_are_searched_once(spark):
    """The run at the end and its two numbers: three searches, however often a bound is used."""
    plan = spark.range(1).select(X.salary_bounds(F.col("id").cast("string")).alias("b")).select("b.lo", "b.hi")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract(") + text.count("RLIKE") == 3
    assert column(spark, [None, "-1,5-+2", "9-1-2", "5-"], X.salary_bounds) == [(None, None), (-1.5, 2), (-1, 2), (None, None)]


def test_numeric(spark):
    cases = {"3.0": 3, "1,5": 1.5, "1,234.5": None, " 7 ": 7, ".5": 0.5, "abc": None, "": None, "1.5f": None,
             " 7": 7, "1e5": None, "1.e2": 100}
    assert column(spark, list(cases), X.to_numeric) == list(cases.values())
    assert column(spark, ["3.0", "1,5", "-2"], lambda c: X.render_number(X.to_numeric(c))) == ["3", "1.5", "-2"]


def test_html_to_text(spark):
    cases = {"<li>1<li>2<link rel=x>3": "1\n2\n3", "<pre>x</pre>y": "x\ny", "x &lt;b&gt; y": "x &lt;b&gt; y",
             "List<String> ok": "List ok", "a <br/> b": "a\nb"}
    assert column(spark, list(cases), X.html_to_text) == list(cases.values())


def test_tracking_url(spark):
    same = ["http://a/b-c", "http://a?p=%%%", "http://a?p=abcde", "http://a?q=1", "http://a?p="]
    assert column(spark, same, X.unwrap_tracking_url) == same


def test_key(spark):
    df = spark.range(1).select(X.vacancy_key(
        F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"), F.lit(7), F.lit(0)).alias("k"))
    assert df.first().k == "d7777afc69fd5179c9c3f4a3b647684b"


def test_dates(spark):
    cases = {
        "Tue, 02 Jan 2024 03:04:05 +0200": "2024-01-02 01:04:05", "02/01/2024": "2024-01-02 00:00:00",
        "2024-01-02 03:04:05": "2024-02-01 03:04:05", "2024-02-13 01:02:03": "2024-02-13 01:02:03",
        "1/31/2024": "2024-01-31 00:00:00", "Mon, 1 Jul 2024 10:00:00 -0330 (NDT)": "2024-07-01 13:30:00",
        "Mon, 5 Feb 2024 10:20:30 EST": "2024-02-05 15:20:30", "5 Feb 24 10:20:30 GMT": "2024-02-05 10:20:30",
        "5 Feb 99": "1999-02-05 00:00:00", "Feb 5, 2024 10:20:30 PDT": "2024-02-05 17:20:30",
        "2024-02-13 01:02:03.250": "2024-02-13 01:02:03", "February 5 2024": "2024-02-05 00:00:00",
        "2 January 2024": "2024-01-02 00:00:00", "nope": None, "": None, "30 Feb 2024": None, "31/31/2024": None,
    }
    got = column(spark, list(cases), lambda c: X.parse_date(c).cast("string"))
    assert got == list(cases.values())


def test_clean(spark):
    assert column(spark, ["English B2 - Upper Intermediate", "  ", "No English", "x", None],
                  lambda c: X.clean(c, "lingvo")) == ["B2", None, "", "x", None]
    assert column(spark, ["No experience", "3 years of experience"], lambda c: X.clean(c, "experience")) == ["0", "3"]


def test_split(spark):
    cases = {
        "A\nB\n\n\nC\nSubscription: z": ["A\nB", "C\nSubscription: z"],
        "A\nB\nSubscription: z\n\n": ["A\nB\nSubscription: z", ""], "A\n\nB": ["A\nB"],
        "A\nSubscription: z\n\nB\n\nC\nSubscription: y": ["A\nSubscription: z", "B\nC\nSubscription: y"],
    }
    assert column(spark, list(cases), chat.split_parts) == list(cases.values())


def test_split_blank_lines(spark):
    """Three line ends are one token and one line end, which splits again."""
    assert column(spark, ["A\nB\n\n\nC"], chat.split_parts) == [["A\nB", "C"]]


def test_location_and_experience(spark):
    texts = ["P в C\nKyiv, Lviv, 1 year of experience\nhttps://djinni.co/jobs/1/\nSubscription: s",
             "P\nRemote, No experience\nd1\nd2\nhttps://djinni.co/jobs/2/\nSubscription: \"s\"", "one line"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "message_id int, text string")
    a, b, c = chat.extract_vacancies(df).orderBy("message_id").collect()
    assert (a.position, a.company, a.location, a.experience, a.parsing_error) == ("P", "C", "Kyiv, Lviv", 1.0, None)
    assert (b.location, b.experience, b.subscription, b.job_desc_prev, b.parsing_error) == ("Remote", 0.0, "s", "d1\nd2", "company")
    assert c.quarantine == "single_line_part"


def test_chat_types(spark):
    cases = {"x __Subscription:__": 1, "Statistics on Djinni for the query Подписка": 2, "Statistics on Djinni for the query /help": 3,
             "": 3, "short": 3, "with space": 4, " Subscription": 4, "aSubscription": 1, "longer-than-ten": 4}
    assert column(spark, list(cases), classify.chat_type) == list(cases.values())


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 2))),
                min_size=1, max_size=60))
def test_percentiles(spark, rows):
    """Bucketed percentiles equal the built-in exact ones."""
    df = spark.createDataFrame(rows, "g string, v double")
    probs = {"p25": 0.25, "p50": 0.5, "p99": 0.99}
    got = {r.g: [r[p] for p in probs] for r in grouped_percentiles(df, ["g"], "v", probs).collect()}
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", list(probs.values())).alias("p")).collect()}
    assert got.keys() == want.keys()
    for g in got:
        assert got[g] == pytest.approx(want[g], rel=1e-9, abs=1e-6)


def test_percentiles_of_a_hot_group(spark):
    """One group holds almost every row, and one value a third of them."""
    df = spark.range(30000).select(F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("g"),
                                   F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") % 997).cast("double").alias("v"))
    got = {r.g: r.p50 for r in grouped_percentiles(df, ["g"], "v", {"p50": 0.5}).collect()}
    want = {r.g: r.p for r in df.groupBy("g").agg(F.percentile("v", 0.5).alias("p")).collect()}
    assert got == want


def test_links_are_unwrapped_fast(spark):
    """A link costs some ten microseconds; a search for what has to be cut from it cost seventy."""
    wrapped = lambda i: "https://mandrillapp.com/track/click/1/x?p=" + base64.urlsafe_b64encode(
        json.dumps({"p": json.dumps({"url": f"https://djinni.co/jobs/{i}-x/"})}).encode()).decode().rstrip("=")
    links = spark.createDataFrame([(wrapped(i),) for i in range(2000)], "link string").repartition(1).localCheckpoint()
    many = links.crossJoin(F.broadcast(spark.range(0, 50, 1, 1)))
    assert [r[0] for r in links.limit(3).select(X.unwrap_tracking_url(F.col("link"))).collect()][0].startswith("https://djinni.co/jobs/")

    def seconds():
        start = time.time()
        many.select(X.unwrap_tracking_url(F.col("link"))).write.format("noop").mode("overwrite").save()
        return time.time() - start

    assert min(seconds() for _ in range(3)) < 4


def test_links_with_signs_to_cut(spark):
    """Signs that are not of the alphabet are left out of a packed link, the two of the url alphabet are read."""
    packed = base64.b64encode(json.dumps({"p": json.dumps({"url": "https://djinni.co/jobs/7-x/", "a": "??>>~~"})}).encode()).decode()
    assert "+" in packed or "/" in packed
    url = packed.replace("+", "-").replace("/", "_")
    links = [f"https://x/y?p={url}", f"https://x/y?p={url[:9]}%20.{url[9:]}%C3%A9!", f"https://x/y?p={url[:5]}!%22*({url[5:]}&b=1"]
    assert column(spark, links, X.unwrap_tracking_url) == ["https://djinni.co/jobs/7"] * 3


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["a", " ", "  ", "\t", "\n", "\r", "\u00a0", "\x1c", "<b>", "<", ">", "</p>", "<br/>", "."]), max_size=6).map("".join), min_size=60, max_size=60))
def test_texts_without_markup_are_only_trimmed(spark, texts):
    """The short way gives what all steps give."""
    def steps(c):
        for pattern, replacement in X.D.TEXT_STEPS:
            c = F.regexp_replace(c, pattern.replace("{WS}", X.WS), replacement)
        return c

    texts = [*texts, None]
    assert column(spark, texts, X.html_to_text) == column(spark, texts, steps)
