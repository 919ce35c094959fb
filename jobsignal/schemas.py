"""Enumerations and table schemas of the vacancy store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Ids and names of the three dimensions.
SOURCES = {1: "WEB", 2: "EMAIL", 3: "TELEGRAM"}
WEB, EMAIL, CHAT = 1, 2, 3

MESSAGE_TYPES = {
    1: "TG_VACANCY",
    2: "TG_STATISTIC",
    3: "TG_SERVICE",
    4: "TG_UNKNOWN",
    5: "EMAIL_VACANCY",
    6: "EMAIL_UNKNOWN",
}
CHAT_VACANCY, CHAT_STATISTIC, CHAT_SERVICE, CHAT_UNKNOWN, MAIL_VACANCY, MAIL_UNKNOWN = range(1, 7)

ATTRS = [
    (1, "POSITION", "string"),
    (2, "LOCATION", "string"),
    (3, "EXPERIENCE", "float"),
    (4, "MAIN_TECH", "string"),
    (5, "TECH_STACK", "string"),
    (6, "LINGVO", "string"),
    (7, "SALARY_FROM", "integer"),
    (8, "SALARY_TO", "integer"),
    (9, "JOB_DESC_PREV", "string"),
    (10, "COMPANY", "string"),
    (11, "COMPANY_TYPE", "string"),
    (12, "DOMAIN", "string"),
    (13, "OFFICES", "string"),
    (14, "EMPLOYMENT", "string"),
    (15, "CANDIDATE_LOCATIONS", "string"),
    (16, "SUBSCRIPTION", "string"),
    (17, "URL", "string"),
    (18, "JOB_DESC", "string"),
    (19, "NOTES", "string"),
]
ATTR_IDS = {name.lower(): attr_id for attr_id, name, _ in ATTRS}
NUMERIC_ATTRS = [name.lower() for _, name, kind in ATTRS if kind != "string"]
# The url lives in vacancy_web and is never stored as an attribute.
STORED_ATTRS = [name.lower() for _, name, _ in ATTRS if name != "URL"]


def _table(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_S, _L, _I, _D, _TS, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType(), T.BinaryType()

TABLES = {
    "raw_messages": _table(
        ("raw_key", _S, False), ("message_id", _L, True), ("email_uid", _L, True), ("date", _TS, False),
        ("text_key", _B, True), ("html_key", _B, True), ("message_source_id", _I, False),
        ("message_type_id", _I, False), ("raw_parsing_error", _S, True)),
    "vacancies": _table(
        ("data_hash", _S, False), ("raw_key", _S, True), ("message_parsing_error", _S, True),
        ("web_parsing_error", _S, True), ("month", _S, True)),
    "vacancy_data": _table(
        ("attr_id", _I, False), ("attr_value", _S, False), ("attr_source_id", _I, False)),
    "vacancy_data_vacancies_links": _table(
        ("data_hash", _S, False), ("attr_id", _I, False), ("attr_value", _S, False), ("attr_source_id", _I, True),
        ("written", _TS, True), ("month", _S, True)),
    "vacancy_web": _table(
        ("url", _S, False), ("canonical_url", _S, False), ("page_key", _B, True), ("last_check", _TS, True),
        ("status_code", _I, True), ("parsing_date", _TS, True), ("data_hash", _S, True)),
    # A url as it was seen before its page named another one.
    "url_aliases": _table(("seen_url", _S, False), ("url", _S, False)),
    # Texts of messages, mails and pages under their keys.
    "bodies": _table(("body_key", _B, False), ("body", _S, False)),
    "statistic": _table(
        ("raw_key", _S, False), ("vacancies_in_30d", _D, True), ("candidates_online", _D, True),
        ("min_salary", _D, True), ("max_salary", _D, True), ("responses_to_vacancies", _D, True),
        ("vacancies_per_week", _D, True), ("candidates_per_week", _D, True), ("stat_parsing_error", _S, True)),
    "service": _table(("raw_key", _S, False), ("text", _S, True)),
    "quarantine": _table(
        ("raw_key", _S, True), ("part_no", _I, True), ("reason", _S, False), ("payload", _S, True)),
}

# How tables are laid out: partition column -> its value. ``month`` is that of the message (yyyy-MM).
_SOURCE = "split_part(raw_key, '-', 1)"
PARTITIONS = {
    "raw_messages": {"p_source": "message_source_id", "p_month": "date_format(date, 'yyyy-MM')"},
    "vacancies": {"p_source": _SOURCE, "p_month": "month"},
    "vacancy_data_vacancies_links": {"p_month": "month"},
}

FETCH_LOG = _table(("url", _S, False), ("status", _I, True), ("html", _S, True), ("fetched", _TS, True))


def sources_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(SOURCES.items()), "message_source_id int, source_name string")


def types_frame(spark: SparkSession) -> DataFrame:
    rows = [(i, name, name.lower()) for i, name in MESSAGE_TYPES.items()]
    return spark.createDataFrame(rows, "message_type_id int, type_name string, config_name string")


def attrs_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ATTRS, "attr_id int, attr_name string, attr_type string")
