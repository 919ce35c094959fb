"""Derived tables the queries share, each written once per application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal import schemas as S
from jobsignal.functions import scalars as X
from jobsignal.operators import chat as chat_ops
from jobsignal.operators import classify, fetching, mail as mail_ops, merge, reshape, web as web_ops
from jobsignal.sources import fixtures
from jobsignal.sources.fixtures import landed, table
from jobsignal.sources.selecting import select
from jobsignal.sources.shred import shred

__all__ = ["table", "chat", "typed_chat", "mails", "emls", "links", "mail_nodes", "mail_signs", "pages", "page_nodes", "chat_vacancies",
           "mail_vacancies", "web_vacancies", "vacancies", "all_long", "report", "chat_long", "fetch_results", "newest_fetch", "user_urls", "day"]


def day(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "chat", fixtures.chat, spread=False)


def typed_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.with_chat_type(chat(spark, sf_dir))


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "mail", fixtures.mail, spread=False)


def emls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "eml", fixtures.eml)


def mail_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mails with the hits that tell their type."""
    return select(mails(spark, sf_dir), classify.MAIL_SIGNS)


def mail_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred(mails(spark, sf_dir))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "links", fixtures.links)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "web", fixtures.web)


def page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shred(table(spark, sf_dir, "pages").select("page_id", "html"))


def extract_chat(messages: DataFrame, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Typed messages to keyed vacancy rows; ``keep`` names columns to carry along."""
    vacancies = chat_ops.extract_vacancies(
        messages.where(F.col("message_type_id") == S.CHAT_VACANCY).select("message_id", "date", *keep, "text"))
    return vacancies.withColumn("data_hash", X.vacancy_key(F.col("date"), F.col("message_id"), F.col("part_no")))


def extract_mail(mails_df: DataFrame, keep: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Mails as html to keyed vacancy rows of both layouts.

    The layout depends on the date alone, so mails are routed before they are
    read and each is read once.
    """
    routed = mail_ops.route_template(mails_df.select("email_uid", "date", *keep, "html"))
    return _keyed_mail(*[mail_ops.hits_of(routed.where(F.col("layout") == i), i) for i in (0, 1)])


def extract_shredded_mail(nodes: DataFrame) -> DataFrame:
    """The same for mails whose hits are staged already."""
    routed = mail_ops.route_template(nodes)
    return _keyed_mail(*[routed.where(F.col("layout") == i) for i in (0, 1)])


def _keyed_mail(old: DataFrame, new: DataFrame) -> DataFrame:
    wanted = classify.mail_type(F.col("nodes")) == S.MAIL_VACANCY
    vacancies = mail_ops.extract_v0(old.where(wanted)).unionByName(mail_ops.extract_v1(new.where(wanted)))
    return vacancies.withColumn("data_hash", X.vacancy_key(F.col("date"), F.col("email_uid"), F.col("part_no")))


def extract_web(pages_df: DataFrame) -> DataFrame:
    return web_ops.extract_page(web_ops.hits_of(pages_df))


def chat_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "chat_vacancies", lambda s, d: extract_chat(typed_chat(s, d)), spread=False)


def mail_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "mail_vacancies", lambda s, d: extract_mail(mails(s, d)), spread=False)


def web_vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed(spark, sf_dir, "web_vacancies", lambda s, d: extract_web(pages(s, d)), spread=False)


def chat_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long attributes of chat vacancies with the columns that order their writes."""
    return reshape.to_long(chat_vacancies(spark, sf_dir), ["data_hash", "date", "message_id", "part_no"])


# When the pages were parsed; later than any message.
PARSED = "2026-01-01 00:00:00"


def vacancies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good vacancies of chat and mails: ``data_hash, origin, date, ident, part_no, canonical_url`` and attributes."""
    ids = lambda df, origin, ident: df.where("quarantine IS NULL").withColumns({
        "origin": F.lit(origin), "ident": F.col(ident), "canonical_url": X.canonical_url(F.col("url"))})
    chat_rows = ids(chat_vacancies(spark, sf_dir), "chat", "message_id")
    return chat_rows.unionByName(ids(mail_vacancies(spark, sf_dir), "mail", "email_uid"), allowMissingColumns=True)


def all_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long attributes of all vacancies with source and time of writing: chat, mails, and the pages of their urls.

    A page belongs to the newest vacancy of each origin that has its url.
    """
    rows, order = vacancies(spark, sf_dir), ["date", "ident", "part_no"]
    own = reshape.to_long(rows, ["data_hash", "origin", "date"]).select(
        "data_hash", "attr_id", "attr_value", F.when(F.col("origin") == "chat", S.CHAT).otherwise(S.EMAIL).alias("attr_source_id"), F.col("date").alias("written"))
    pointed = merge.latest_per_key(rows.select("origin", "canonical_url", "data_hash", *order), ["origin", "canonical_url"], order)
    good = web_vacancies(spark, sf_dir).where("quarantine IS NULL").join(
        pointed.select(F.col("canonical_url").alias("page_url"), "data_hash"), "page_url")
    pages_long = reshape.to_long(good, ["data_hash"]).select(
        "*", F.lit(S.WEB).alias("attr_source_id"), F.lit(PARSED).cast("timestamp_ntz").alias("written"))
    return own.unionByName(pages_long)


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One typed row per vacancy of any source; numbers are the last writer's."""
    wide = reshape.typed(reshape.to_wide(all_long(spark, sf_dir), newest=["written", "attr_source_id"]))
    return wide.join(vacancies(spark, sf_dir).select("data_hash", "origin", "date"), "data_hash")


def fetch_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetching.fetch_rows(landed(spark, sf_dir, "fetch", fixtures.fetch_results))


def newest_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetching.newest_results(fetching.detect_blocked(fetch_results(spark, sf_dir)))


def user_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Url table before any fetch, in the shape of ``vacancy_web``."""
    null = lambda kind: F.lit(None).cast(kind)
    return fixtures.user_urls(spark, sf_dir).select(
        "url", null("binary").alias("page_key"), null("timestamp_ntz").alias("last_check"),
        null("int").alias("status_code"), null("timestamp_ntz").alias("parsing_date"),
        F.col("user_id").cast("string").alias("data_hash"))
