"""Newsletter mails: card extraction for both layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal.functions import dom
from jobsignal.functions import scalars as X
from jobsignal.operators.classify import SIGNS, mail_layout
from jobsignal.sources.selecting import Pick, Picks, select, text

FIELDS = ["position", "location", "experience", "lingvo", "salary_from", "salary_to", "job_desc_prev", "company",
          "employment", "candidate_locations", "subscription", "url"]


def route_template(mails: DataFrame, date: str = "date") -> DataFrame:
    return mails.withColumn("layout", mail_layout(F.col(date)))


def _picks(selectors: dict, **texts: str) -> Picks:
    named = {name: Pick(path, texts.get(name, "joined"), "href" if name == "position" else "") for name, path in selectors.items()}
    return Picks(**SIGNS, **named)


# The automaton of each layout; a card's own text is never needed.
PICKS = {0: _picks(D.MAIL_V0, card=""), 1: _picks(D.MAIL_V1, card="", company_box="", details="raw")}


def hits_of(mails: DataFrame, layout: int) -> DataFrame:
    """Mails of one layout with ``nodes``, the hits of its automaton, for their html."""
    return select(mails, PICKS[layout])


def _cards(mails: DataFrame, layout: int) -> DataFrame:
    """One row per card holding only the hits inside it."""
    kept = [c for c in mails.columns if c != "nodes"]
    cards = dom.find_all(F.col("nodes"), PICKS[layout].test("card"))
    return mails.select(*kept, F.posexplode(cards).alias("part_no", "card"))


def _found(fragment: str | Column, layout: int, name: str) -> Column:
    return dom.find(F.col(fragment) if isinstance(fragment, str) else fragment, PICKS[layout].test(name))


def _node(fragment: str, layout: int, name: str) -> Column:
    return dom.first(F.col(fragment), PICKS[layout].test(name))


def _null_fields(df: DataFrame, present: set[str]) -> list[Column]:
    numeric = {"experience", "salary_from", "salary_to"}
    return [F.col(f) if f in present else F.lit(None).cast("double" if f in numeric else "string").alias(f)
            for f in FIELDS]


def _v0_texts(mails: DataFrame) -> DataFrame:
    """Texts of every layout-0 card, its details in pieces and the one of them that tells experience."""
    kept = [c for c in mails.columns if c != "nodes"]
    frags = _cards(mails, 0).select(
        *kept, "part_no", _node("card", 0, "position").alias("link"),
        _node("card", 0, "company")["text"].alias("company_text"),
        _found("card", 0, "details").alias("details"),
        _node("card", 0, "description")["text"].alias("desc_text"))
    texts = frags.select(
        *kept, "part_no", "company_text", "desc_text",
        F.col("link.text").alias("position"),
        X.unwrap_tracking_url(F.col("link.value")).alias("url"),
        F.coalesce(text(F.col("details")), F.lit("")).alias("details_text"),
        F.coalesce(_node("details", 0, "salary")["text"], F.lit("")).alias("salary_text"))
    texts = texts.withColumn("salary_text", F.when(F.col("details_text") != "", F.col("salary_text")).otherwise(""))
    pieces = texts.withColumn("pieces", X.split_middot(
        F.replace(F.col("details_text"), F.col("salary_text"), F.lit("")), keep_blanks=False)
    ).withColumn("bounds", X.salary_bounds(F.col("salary_text")))
    first, second = F.get("pieces", F.lit(0)), F.get("pieces", F.lit(1))
    badge = F.coalesce(F.contains(F.coalesce(second, first), F.lit(D.PRODUCT_BADGE)), F.lit(False))
    return pieces.withColumn("badge", badge).withColumn("experience_text", F.when(badge | second.isNull(), first).otherwise(second))


def extract_v0(mails: DataFrame) -> DataFrame:
    """Layout 0: one table cell per vacancy. Input: mails with the hits of ``PICKS[0]`` as ``nodes``."""
    kept = [c for c in mails.columns if c != "nodes"]
    pieces, badge, experience_text = _v0_texts(mails), F.col("badge"), F.col("experience_text")
    first, second = F.get("pieces", F.lit(0)), F.get("pieces", F.lit(1))
    has_details = F.col("details_text") != ""
    broken = has_details & ((F.size("pieces") == 0) | (badge & second.isNull()))
    fields = pieces.select(
        *kept, "part_no", "position", "url", "salary_text",
        X.clean(F.col("company_text"), "mail_company").alias("company"),
        F.when(~badge & second.isNotNull(), first).alias("location"),
        X.truthy(X.to_numeric(X.clean(experience_text, "experience"))).alias("experience"),
        X.truthy(F.col("bounds.lo")).alias("salary_from"), X.truthy(F.col("bounds.hi")).alias("salary_to"),
        X.clean(F.col("desc_text"), "mail_description").alias("job_desc_prev"),
        F.when(broken, F.lit("salary_only_line")).when(F.col("url").isNull(), F.lit("missing_url"))
        .alias("quarantine"))
    priced = F.contains("salary_text", F.lit("$"))
    audit = [("position", None), ("url", None), ("company", None), ("salary_from", priced), ("salary_to", priced),
             ("experience", None), ("job_desc_prev", None)]
    return _result(fields, kept, audit)


def details(mails: DataFrame, layout: int) -> DataFrame:
    """``pieces``: dot-separated details of every card as they are written."""
    kept = [c for c in mails.columns if c != "nodes"]
    return (_v1_texts(mails) if layout else _v0_texts(mails)).select(*kept, "part_no", "pieces")


def dictionary_texts(mails: DataFrame, layout: int) -> DataFrame:
    """dict and source_text of every text of a card that a dictionary is applied to."""
    kept = [c for c in mails.columns if c != "nodes"]
    if layout:
        texts = {name: F.get("pieces", F.lit(i)) for i, name in enumerate(["experience", "lingvo", "employment", "candidate_locations"])}
        texts |= {"mail_description": F.col("desc_text"), "mail_subscription": F.col("subscription_text")}
    else:
        texts = {"mail_company": F.col("company_text"), "experience": F.col("experience_text"), "mail_description": F.col("desc_text")}
    named = F.array(*[F.struct(F.lit(name).alias("dict"), value.alias("source_text")) for name, value in texts.items()])
    rows = (_v1_texts(mails) if layout else _v0_texts(mails)).select(*kept, "part_no", F.explode(named).alias("t"))
    return rows.select(*kept, "part_no", "t.*").where(F.col("source_text").isNotNull())


def _v1_texts(mails: DataFrame) -> DataFrame:
    """Texts of every layout-1 card and its details in pieces.

    A heading around the whole card also counts as ancestor of the card's links.
    """
    kept = [c for c in mails.columns if c != "nodes"]
    frags = _cards(mails, 1).select(
        *kept, "part_no", _node("card", 1, "position").alias("link"),
        F.coalesce(_node("card", 1, "salary")["text"], F.lit("")).alias("salary_text"),
        text(_found(_found("card", 1, "company_box"), 1, "company")).alias("company"),
        _node("card", 1, "details")["text"].alias("details_text"),
        _node("card", 1, "description")["text"].alias("desc_text"),
        _node("card", 1, "subscription")["text"].alias("subscription_text"))
    return frags.select(
        *kept, "part_no", "salary_text", "company", "desc_text", "subscription_text",
        F.col("link.text").alias("position"),
        X.unwrap_tracking_url(F.col("link.value")).alias("url"),
        X.split_middot(F.col("details_text"), keep_blanks=True).alias("pieces"),
        X.salary_bounds(F.col("salary_text")).alias("bounds"))


def extract_v1(mails: DataFrame) -> DataFrame:
    """Layout 1: one ``div.card`` per vacancy. Input: mails with the hits of ``PICKS[1]`` as ``nodes``."""
    kept = [c for c in mails.columns if c != "nodes"]
    pieces = _v1_texts(mails)
    years = rf"{D.NUMERIC_PATTERN}? ?({D.any_of(D.REMOVALS['experience'])})"
    piece = lambda i: F.get("pieces", F.lit(i))
    number = F.regexp_extract(piece(0), years, 1)
    fields = pieces.select(
        *kept, "part_no", "position", "company", "url", "salary_text",
        F.when(piece(0).rlike(years) & (number == ""), F.lit(0.0)).otherwise(X.to_numeric(number))
        .alias("experience"),
        X.clean(piece(1), "lingvo").alias("lingvo"),
        X.clean(piece(2), "employment").alias("employment"),
        X.clean(piece(3), "candidate_locations").alias("candidate_locations"),
        X.truthy(F.col("bounds.lo")).alias("salary_from"), X.truthy(F.col("bounds.hi")).alias("salary_to"),
        X.clean(F.col("desc_text"), "mail_description").alias("job_desc_prev"),
        X.clean(F.col("subscription_text"), "mail_subscription").alias("subscription"),
        F.when(F.size("pieces") < 4, F.lit("short_details")).when(F.col("url").isNull(), F.lit("missing_url"))
        .alias("quarantine"))
    priced = F.contains("salary_text", F.lit("$"))
    audit = [("position", None), ("url", None), ("salary_from", priced), ("salary_to", priced), ("experience", None),
             ("employment", None), ("candidate_locations", None), ("job_desc_prev", None), ("subscription", None)]
    return _result(fields, kept, audit)


def _result(fields: DataFrame, kept: list[str], audit: list[tuple[str, Column | None]]) -> DataFrame:
    present = set(fields.columns)
    return fields.select(
        *kept, "part_no", *_null_fields(fields, present),
        X.missing_report(audit, bare_single=True).alias("parsing_error"),
        "quarantine")

