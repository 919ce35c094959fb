"""Landed inputs: chat messages, raw mail files, fetch logs, and the high-water mark."""

from __future__ import annotations

import email
import sys
from collections.abc import Iterator
from email.header import decode_header
from email.message import Message

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal import schemas as S
from jobsignal.functions import scalars as X
from jobsignal.operators.classify import with_chat_type

# Functions of this module travel to the workers by value; nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHAT_SCHEMA = "message_id bigint, date timestamp_ntz, text string, raw_message string, message string"
MAIL_SCHEMA = ("email_uid bigint, sender string, subject string, date_text string, text string, html string, "
               "n_attachments int")


def read_chat(spark: SparkSession, path: str) -> DataFrame:
    """Landed chat JSON in one shape: the text comes from the first field that has one."""
    return chat_rows(spark.read.schema(CHAT_SCHEMA).json(path))


def chat_rows(landed: DataFrame) -> DataFrame:
    text = F.coalesce("text", "raw_message", "message", F.lit(""))
    rows = landed.select("message_id", "date", text.alias("text"), F.lit(S.CHAT).alias("message_source_id"))
    return with_chat_type(rows)


def high_water(stored: DataFrame, source: int, from_first: bool = False) -> DataFrame:
    """One row: newest stored date of a source, or the start date."""
    start = F.lit(D.START_DATE).cast("timestamp_ntz")
    newest = F.max(F.when(F.col("message_source_id") == source, F.col("date")))
    return stored.agg((start if from_first else F.coalesce(newest, start)).alias("mark"))


def new_chat(incoming: DataFrame, mark: DataFrame) -> DataFrame:
    """Messages above the last one that is older than the mark; the mark itself is read again.

    Messages without date or id can't be placed and are always read again.
    """
    older = incoming.where(F.col("date") < mark.scalar())
    last_id = older.agg(F.max_by("message_id", F.struct("date", "message_id"))).scalar()
    unplaced = F.col("message_id").isNull() | F.col("date").isNull()
    return incoming.where(unplaced | (F.col("message_id") > F.coalesce(last_id, F.lit(0))))


def new_mail(incoming: DataFrame, mark: DataFrame) -> DataFrame:
    """Mails since the day of the mark, and undated ones; the search has day precision, so that day repeats."""
    return incoming.where(F.col("date").isNull() | (F.col("date") >= F.date_trunc("day", mark.scalar()).cast("timestamp_ntz")))


def last_before_date(messages: DataFrame, date: str, key: str) -> DataFrame:
    """Newest message before a date."""
    return (messages.where(F.col("date") < F.lit(date).cast("timestamp_ntz"))
            .orderBy(F.desc("date"), F.desc(key)).limit(1))


# ------------------------------------------------------------------------- mail

def _mail_row(uid: int, content: bytes) -> tuple:
    """Headers and bodies of one message; of several bodies of a kind the last wins."""
    message = email.message_from_bytes(content)
    text, html, attached = "", "", 0
    for part in message.walk() if message.is_multipart() else [message]:
        kind = part.get_content_type()
        if kind == "text/html":
            html = _body(part)
        elif kind == "text/plain" or part is message and not message.is_multipart():
            text = _body(part)
        elif part.get_content_disposition() == "attachment":
            attached += 1
    return uid, _header(message["From"]), _header(message["Subject"]), message["Date"], text, html, attached


def _header(value: object) -> str:
    """Encoded words to text; folded lines are joined."""
    pieces = decode_header("".join(str(value).splitlines())) if value is not None else []
    return "".join(p.decode(charset or "utf-8", errors="ignore") if isinstance(p, bytes) else p for p, charset in pieces)


def _body(part: Message) -> str:
    payload = part.get_payload(decode=True)
    if not isinstance(payload, bytes):
        return str(payload)
    try:
        return payload.decode(part.get_content_charset("ascii"), errors="replace")
    except LookupError:
        return payload.decode("utf-8", errors="ignore")


def parse_mail(files: DataFrame) -> DataFrame:
    """``email_uid, content`` bytes to headers, bodies and UTC date."""
    names = ["email_uid", "sender", "subject", "date_text", "text", "html", "n_attachments"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                part = batch.slice(start, 128)
                uids = part.column("email_uid").to_pylist()
                rows = [_mail_row(u, part.column("content")[i].as_py()) for i, u in enumerate(uids)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    parsed = files.select("email_uid", "content").mapInArrow(run, MAIL_SCHEMA)
    return parsed.withColumn("date", X.parse_date(F.col("date_text"))).drop("date_text")


def read_mail(spark: SparkSession, path: str) -> DataFrame:
    """``.eml`` files of a folder; the file name's digits are the uid."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.eml").load(path)
    uid = F.regexp_extract("path", r"(\d+)\.eml\z", 1).cast("bigint")
    return parse_mail(files.select(uid.alias("email_uid"), "content"))


def mail_audit(mails: DataFrame) -> DataFrame:
    fields = [(name, None) for name in ("email_uid", "date", "text", "html")]
    return mails.withColumn("raw_parsing_error", X.missing_report(fields, bare_single=False))
