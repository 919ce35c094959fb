"""Inputs rendered by Spark from the given tables (see FIXTURES.md).

Every row of the driving table takes part: each order becomes one chat message and
one newsletter mail, each part one vacancy page, each event one fetch result. The
texts are a pure function of the source columns, so the expected results can be
computed from those columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.session import input_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build, files: int | None = None, spread: bool = True) -> DataFrame:
    """Write a derived input once per application to the shared folder and read it back.

    The real jobs start from landed files; writing them also cuts lineage, so losing
    an executor re-reads files instead of rendering everything again. Files are as many as
    shuffle partitions are set, so later scans have tasks enough without a shuffle of their own. What is
    in so many partitions already, as rows taken one by one from landed files are, is written as it lies (``spread`` False).
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = f"{input_folder(spark, sf_dir)}/{name}"
        df = build(spark, sf_dir)
        files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
        (df.repartition(files) if spread else df).write.mode("overwrite").parquet(path)
        _LANDED[key] = path
    return spark.read.parquet(_LANDED[key])


def landed_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    return _LANDED[(spark.sparkContext.applicationId, sf_dir, name)]


# ---------------------------------------------------------------- vacancy parts

def order_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per vacancy part of an order: ``o_orderkey, o_orderdate, k, h, pk, e, lo, hi`` and names."""
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    n_part = part.agg(F.count("*")).scalar()
    n_supplier = supplier.agg(F.count("*")).scalar()
    o = F.col("o_orderkey")
    rows = (table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
            .withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), o % 3)))
            .withColumn("h", o * 3 + F.col("k"))
            .withColumn("pk", (o * 7 + F.col("k") * 13) % n_part)
            .withColumn("sk", (o + F.col("k")) % n_supplier))
    return (rows
            .join(part.select(F.col("p_partkey").alias("pk"), "p_name"), "pk")
            .join(supplier.select(F.col("s_suppkey").alias("sk"), "s_name", "s_nationkey"), "sk")
            .join(nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
            .select("o_orderkey", "o_orderdate", "k", "h", "pk", "p_name", "s_name", "n_name",
                    (F.col("h") % 6).alias("e"), *_salary(F.col("h"))))


def _salary(h: Column) -> list[Column]:
    lo = 1000 + 100 * (h % 20)
    hi = 1500 + 100 * (h % 20) + 50 * (h % 7)
    return [F.when(h % 5 != 0, lo).alias("lo"), F.when(h % 5 != 0, hi).alias("hi")]


def _experience(e: Column) -> Column:
    return (F.when(e == 0, F.lit("No experience")).when(e == 1, F.lit("1 year of experience"))
            .otherwise(F.concat(e.cast("string"), F.lit(" years of experience"))))


def _salary_text(before: str = "", after: str = "") -> Column:
    text = F.concat(F.lit(before + "$"), F.col("lo").cast("string"), F.lit("-"),
                    F.col("hi").cast("string"), F.lit(after))
    return F.coalesce(text, F.lit(""))


def _join(*pieces: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces])


def _per_order(parts: DataFrame, text: Column, separator: str, alias: str) -> DataFrame:
    """Parts of an order joined in part order; an order has three parts at most.

    Names and numbers are shuffled, to as many partitions as files are to be landed; the texts are rendered after it.
    """
    files = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = parts.repartition(files, "o_orderkey", "o_orderdate")
    piece = F.struct("k", text.alias("t"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["t"]), separator)
    return parts.groupBy("o_orderkey", "o_orderdate").agg(joined.alias(alias))


# ------------------------------------------------------------------------- chat

def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``message_id, date, text``: vacancies, statistics, service texts and chatter."""
    c = F.col
    part = _join("**", c("p_name"), "** в ", c("s_name"), "\n", c("n_name"), ", ", _experience(c("e")),
                 _salary_text(", "), "\n\nLine A ", c("k"), "\nLine B\n\nhttps://djinni.co/jobs/", c("pk"),
                 "-x/\n__Subscription:__ \"", c("p_name"), "\"")
    o = c("o_orderkey")
    statistic = _join(
        "Statistics on Djinni for the query\nJobs for 30 days: ", o % 500, "\nCandidates online: ", o % 900,
        "\nSalary range: $", 1000 + o % 100, "-", 2000 + o % 100, "\nApplications per job posting: ", o % 40, ".5",
        F.when(o % 50 != 7, _join("\nJobs: ", o % 70)).otherwise(""), "\nCandidates: ", o % 80)
    service = (F.when(o % 30 == 8, F.lit("/help")).when(o % 30 == 18, F.lit("ok"))
               .otherwise(_join("Active Subscriptions: ", o)))
    chatter = F.when(o % 20 == 9, _join("hello ", o, " there")).otherwise(_join("/pause __Subscription:__ ", o))
    kind = o % 10
    return _per_order(order_parts(spark, sf_dir), part, "\n\n", "vacancy").select(
        o.alias("message_id"), c("o_orderdate").alias("date"),
        F.when(kind <= 6, c("vacancy")).when(kind == 7, statistic).when(kind == 8, service)
        .otherwise(chatter).alias("text"))


# ------------------------------------------------------------------------- mail

def tracking_url(pk: Column) -> Column:
    inner = _join('{\\"url\\":\\"https:\\\\/\\\\/djinni.co\\\\/jobs\\\\/', pk, '-x\\\\/\\"}')
    packed = F.regexp_replace(F.base64(F.encode(_join('{"p":"', inner, '"}'), "utf-8")), r"\s", "")
    return _join("https://mandrillapp.com/track/click/1/x?p=",
                 F.regexp_replace(F.replace(F.replace(packed, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_")), "=+$", ""))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, k, tracked, plain``: both spellings of every vacancy's link."""
    return order_parts(spark, sf_dir).select(
        "o_orderkey", "k", tracking_url(F.col("pk")).alias("tracked"), _join("https://djinni.co/jobs/", F.col("pk"), "-x/").alias("plain"))


def mail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``email_uid, date, html``: even orders in layout 0, odd ones in layout 1.

    Orders divisible by 97 carry no card (unknown mails) and, in layout 1, the first
    card of orders with remainder 5 modulo 101 has two details only (quarantined).
    """
    c, o = F.col, F.col("o_orderkey")
    pick = lambda *texts: F.element_at(F.array(*[F.lit(t) for t in texts]), (c("h") % 3 + 1).cast("int"))
    v0 = _join(
        '<tr><td style="padding-bottom:24px; box-sizing:border-box">\n<a style="font-weight:bold; font-size:18px" href="',
        tracking_url(c("pk")), '">', c("p_name"), '</a>\n<span class="djinni-whois-expanded">at ', c("s_name"),
        '</span>\n<p class="djinni-whois-expanded">', c("n_name"), " · ", _experience(c("e")),
        _salary_text(' <span style="color:#4cae4c">', "</span>"),
        '</p>\n<p style="margin:5px 0; color:#333">Desc ', c("h"), "… Read more</p></td></tr>")
    details = F.when((o % 101 == 5) & (c("k") == 0), _join(_experience(c("e")), " · ", pick(
        "Upper-Intermediate", "Intermediate", "Fluent"))).otherwise(_join(
            _experience(c("e")), " · ", pick("Upper-Intermediate", "Intermediate", "Fluent"), " · ",
            pick("Office Work", "Тільки віддалено", "Part-time"), " · ", pick("Україна", "Весь світ", "NATION_1")))
    v1 = _join(
        '<div class="card"><h3><a href="', tracking_url(c("pk")), '">', c("p_name"), "</a>",
        _salary_text(" <span>", "</span>"),
        '</h3>\n<div style="margin-bottom: 8px"><span class="details-text">', c("s_name"),
        '</span></div>\n<table><tr><td class="details">', details,
        '</td></tr></table>\n<p style="margin:0; line-height:1.5">Desc ', c("h"),
        '</p>\n<div class="djinni-whois-expanded">Subscription: ', c("p_name"), "</div></div>")
    start = F.when(o % 2 == 0, F.lit("2024-06-01")).otherwise(F.lit("2025-02-01")).cast("date")
    day = F.date_add(start, (o % 200).cast("int")).cast("timestamp_ntz")
    # Two orders sit exactly on the layout switch and one second after it.
    date = (F.when(o == 2, F.lit("2025-01-24 00:00:00").cast("timestamp_ntz"))
            .when(o == 1, F.lit("2025-01-24 00:00:01").cast("timestamp_ntz")).otherwise(day))
    body = _per_order(order_parts(spark, sf_dir), F.when(o % 2 == 0, v0).otherwise(v1), "\n", "cards")
    html = (F.when(o % 97 == 0, _join("<html><body><p>Digest ", o, "</p></body></html>"))
            .when(o % 2 == 0, _join("<html><body><table>", c("cards"), "</table></body></html>"))
            .otherwise(_join("<html><body>", c("cards"), "</body></html>")))
    return body.select(o.alias("email_uid"), date.alias("date"), html.alias("html"))


# -------------------------------------------------------------------------- web

def web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, html``: one vacancy page per part."""
    c = F.col
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    n_supplier = supplier.agg(F.count("*")).scalar()
    pk = c("p_partkey")
    rows = (table(spark, sf_dir, "part").withColumn("sk", pk % n_supplier)
            .join(supplier.select(F.col("s_suppkey").alias("sk"), "s_name", "s_nationkey"), "sk")
            .join(nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey")
            .select("*", (pk % 6).alias("e"), *_salary(pk)))
    company_type = (F.when(pk % 3 == 0, F.lit("Продукт")).when(pk % 3 == 1, F.lit("Аутсорс"))
                    .otherwise(F.lit("Стартап")))
    link = F.when(pk % 13 == 0, F.lit("")).otherwise(
        _join('<link rel="canonical" href="https://djinni.co/jobs/', pk, '-x/">'))
    third = F.when(pk % 11 == 0, F.lit("")).otherwise(_join(
        "<ul><li>Part-time</li><li>Domain: ", c("p_type"), "</li><li>", company_type, "</li><li>Office: ",
        c("n_name"), "</li></ul>\n"))
    html = _join(
        "<html><head>", link, "</head><body>\n<h1><span>", c("p_name"), "<span>hot</span></span></h1>\n",
        '<div class="fs-5"><div class="col">', c("s_name"), "</div></div>\n",
        '<div class="job-post__description"><p>About ', pk, "</p><ul><li>a</li><li>b</li></ul></div>\n",
        "<h2>Skills</h2><table><tr><td>", c("p_brand"), "</td><td>", c("p_size"),
        " years</td></tr><tr><td>SQL</td><td></td></tr>\n<tr><td>English</td><td>B2</td></tr></table>\n",
        "<h2>Languages</h2><table><tr><td>English</td><td>Upper-Intermediate</td></tr>",
        "<tr><td>German</td><td>B1</td></tr></table>\n",
        '<div class="text-secondary"><div class="col">', c("p_type"), ", SQL</div></div>\n",
        '<aside><div class="card card-body">\n<ul><li><strong>', _experience(c("e")),
        "</strong><small>exp note</small></li>", _salary_text("<li><strong>", "</strong></li>"),
        "<li><strong>Office Work</strong></li>\n<li><strong>Україна</strong></li>",
        "<li><strong>Upper-Intermediate</strong></li></ul>\n",
        '<ul><li><div class="col"><div class="fw-medium">', c("p_brand"), "</div></div></li></ul>\n",
        third, "</div></aside></body></html>")
    return rows.select(_join("https://djinni.co/jobs/", pk).alias("url"), html.alias("html"))


# ------------------------------------------------------------------------ fetch

def fetch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, status, html, ts, event_id``: every event is one fetch attempt."""
    kind, event = F.col("event_type"), F.col("event_id")
    status = F.when(kind == "purchase", 404).when(kind == "error", 0).otherwise(200)
    html = (F.when(kind == "signup", F.lit("Your IP address 1.2.3.4 has been blocked"))
            .when(kind == "error", F.lit("Connection error/timeout: X"))
            .when(kind == "purchase", F.lit(None).cast("string"))
            .otherwise(_join("page ", event)))
    return table(spark, sf_dir, "events").select(
        _join("https://djinni.co/jobs/", F.col("user_id")).alias("url"), status.cast("int").alias("status"),
        html.alias("html"), "ts", "event_id", "user_id")


def user_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Url table before any fetch: one row per user, linked to a vacancy and a raw message."""
    return (table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("date"))
            .select(_join("https://djinni.co/jobs/", F.col("user_id")).alias("url"), "user_id", "date"))


def url_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backup of the url table: urls with a purchase; raw_html is NULL where errors outnumber views.

    Each url occurs once per purchase, so restoring has to settle on the newest row.
    """
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    balance = events.groupBy("user_id").agg(
        (F.count_if(kind == "error") > F.count_if(kind == "view")).alias("lost"))
    rows = events.where(kind == "purchase").join(balance, "user_id")
    return rows.select(
        _join("https://djinni.co/jobs/", F.col("user_id")).alias("url"),
        F.when(~F.col("lost"), _join("backup ", F.col("event_id"))).alias("raw_html"),
        F.lit(200).alias("status_code"), F.col("ts").alias("last_check"), "event_id")


# -------------------------------------------------------------------------- eml

def eml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``email_uid, content``: RFC 822 bytes of a two-part mail per document."""
    c = F.col
    wrap = lambda x: F.regexp_replace(F.regexp_replace(F.base64(F.encode(x, "utf-8")), r"\s", ""), "(.{76})", "$1\r\n")
    subject = F.concat(F.lit("=?utf-8?B?"), F.base64(F.encode(_join("Оголошення ", c("doc_id")), "utf-8")), F.lit("?="))
    day = F.date_add(F.lit("2024-01-01").cast("date"), (c("doc_id") % 300).cast("int"))
    part = lambda kind, body: _join(
        "--cut\r\nContent-Type: ", kind, "; charset=utf-8\r\nContent-Transfer-Encoding: base64\r\n\r\n", wrap(body), "\r\n")
    source = _join(
        "From: News <news@example.com>\r\nSubject: ", subject, "\r\nDate: ",
        F.date_format(day, "d MMM yyyy"), " 10:20:30 +0200\r\nMIME-Version: 1.0\r\n",
        "Content-Type: multipart/alternative; boundary=cut\r\n\r\n",
        part("text/plain", F.lit("overwritten by the next plain part")), part("text/plain", c("text")),
        part("text/html", _join("<div class=\"card\">", c("doc_id"), "</div>")),
        "--cut\r\nContent-Type: application/octet-stream\r\nContent-Disposition: attachment; filename=a.bin\r\n",
        "Content-Transfer-Encoding: base64\r\n\r\nAAEC\r\n--cut--\r\n")
    return table(spark, sf_dir, "documents").select("doc_id", "text").select(
        c("doc_id").alias("email_uid"), F.encode(source, "utf-8").alias("content"))
