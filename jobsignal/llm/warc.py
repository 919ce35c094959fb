"""WARC archives: writing page records, reading them back, reassembling segmented records.

A record is a line of text data to Spark's text writer: header, blank line and block, with the record end as line
separator. So files are committed by Spark like any table, and half-written ones are never read. Blocks longer than
a segment are written as a first record and continuation records, which may lie in any file.

Reading takes files whole (their size is bounded by records per file and bytes per segment), parses records, and
groups continuation records by the identifier of their origin. Segments are ordered by number, checked to be
complete and of the stated total length, and then joined. HTTP blocks carry chunked transfer framing; it is decoded after reassembly.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.common import folder, text_of

SEGMENT_BYTES = 16_384
RECORDS_PER_FILE = 2_000
CHUNK_BYTES = 4_096
BATCH_BYTES = 4_000_000
LEAST_REVISIT = 100  # payloads shorter than this are written again
RECORD_END = "\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
HTTP_REVISIT = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
STAMP = "2024-01-01T00:00:00Z"

RECORD_SCHEMA = ("record_id string, type string, page_id string, url string, digest string, refers_to string, origin string, "
                 "segment long, total long, block binary")


def roles(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and first: the smallest page_id of the pages with the same payload, where it has
    LEAST_REVISIT bytes or more and occurs more than once."""
    payload = text_of("html").cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    shared = (rows.filter(F.octet_length("payload") >= LEAST_REVISIT).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"))
    return rows.join(shared, "digest", "left")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``payload`` in chunked transfer framing."""
    parts = [b"%x\r\n%b\r\n" % (len(part), part) for i in range(0, len(payload), size) if (part := payload[i:i + size])]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions are skipped, and a body that ends early is an error."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        start = end + 2
        if body[start + size:start + size + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        parts.append(body[start:start + size])
        at = start + size + 2


def record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _header_value(text: str | None) -> str | None:
    return None if text is None else re.sub(r"[\r\n]+", " ", text)


def records_of(uid: str, page_id: object, url: str | None, payload: bytes, digest: str, first: object,
               segment_bytes: int) -> Iterator[bytes]:
    """The records of one page: a revisit of another page, or a response in one or more segments."""
    name = f"<urn:page:{uid}>"
    common = [("WARC-Record-ID", name), ("WARC-Date", STAMP), ("WARC-Target-URI", _header_value(url)),
              ("WARC-Page-ID", page_id), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if first is not None and page_id != first:
        fields = [("WARC-Type", "revisit"), *common, ("WARC-Refers-To", f"<urn:page-id:{first}>"),
                  ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                  ("WARC-Full-Length", len(payload)), ("Content-Type", "application/http; msgtype=response")]
        yield record(fields, HTTP_REVISIT)
        return
    block = HTTP_HEAD + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    kind = ("Content-Type", "application/http; msgtype=response")
    if len(parts) == 1:
        yield record([("WARC-Type", "response"), *common, kind], block)
        return
    yield record([("WARC-Type", "response"), *common, ("WARC-Segment-Number", 1), kind], parts[0])
    for number, part in enumerate(parts[1:], 2):
        total = len(block) if number == len(parts) else None
        yield record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:page:{uid}:{number}>"), ("WARC-Date", STAMP),
                      ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", number), ("WARC-Segment-Total-Length", total)], part)


def write_archive(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Gzip-compressed WARC files of all pages in the folder ``path``.

    A null html is an empty payload. Record identifiers number the rows of the table, so pages that repeat an id stay
    apart; of equal payloads every row with the smallest page_id is a response. A null page_id is never a revisit.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines, size = [], 0
        for batch in batches:
            for row in zip(*batch.columns):
                for line in records_of(*(v.as_py() for v in row), segment_bytes):
                    lines.append(line)
                    size += len(line)
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["value"])
                        lines, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], names=["value"])

    rows = roles(pages).select(F.uuid().alias("uid"), "page_id", "url", "payload", "digest",
                               F.when(F.col("page_id").isNotNull(), F.col("first")).alias("first"))
    # one record per line; bytes pass through a string column unchanged
    (rows.mapInArrow(run, "value binary").select(F.col("value").cast("string"))
     .write.option("lineSep", RECORD_END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


HEADER = re.compile(rb"WARC/1\.[01]\r\n")


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (lower-case names) and block of each record of an uncompressed archive."""
    at = 0
    while at < len(data):
        head = HEADER.match(data, at)
        if not head:
            raise ValueError(f"no record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        pairs = (line.split(b":", 1) for line in data[head.end():end].split(b"\r\n"))
        fields = {name.decode().strip().lower(): value.decode("utf-8", "surrogatepass").strip() for name, value in pairs}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield fields, data[start:stop]
        at = stop + 4


def unpacked(content: bytes) -> bytes:
    """All gzip members of a file, or the file itself if it isn't compressed."""
    if content[:2] != b"\x1f\x8b":
        return content
    parts = []
    while content:
        member = zlib.decompressobj(31)
        parts.append(member.decompress(content))
        content = member.unused_data
    return b"".join(parts)


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archive files in ``path``, segments apart (RECORD_SCHEMA)."""
    columns = ["warc-record-id", "warc-type", "warc-page-id", "warc-target-uri", "warc-payload-digest", "warc-refers-to", "warc-segment-origin-id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([pa.field(n, t) for n, t in zip(
            ["record_id", "type", "page_id", "url", "digest", "refers_to", "origin", "segment", "total", "block"],
            [pa.string()] * 7 + [pa.int64()] * 2 + [pa.binary()])])
        for batch in batches:
            for content in batch.column(0):
                rows = [[*(f.get(c) for c in columns), _number(f.get("warc-segment-number")),
                         _number(f.get("warc-segment-total-length") or f.get("warc-full-length")), block]
                        for f, block in parse(unpacked(content.as_py()))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, RECORD_SCHEMA)


def _complete(parts: Column, total: Column) -> Column:
    """Joined blocks of sorted ``parts`` (segment, block); null unless they are 1, 2, ... and as long as stated."""
    whole = F.array_join(F.transform(parts, lambda p: p["block"].cast("string")), "").cast("binary")  # bytes stay as they are
    numbered = F.transform(parts, lambda p: p["segment"]) == F.sequence(F.lit(1).cast("long"), F.size(parts).cast("long"))
    return F.when(numbered & (F.octet_length(whole) == total), whole)


def reassembled(records: DataFrame) -> DataFrame:
    """Records with whole blocks; ``complete`` is false, and the block null, where a segment is missing or lengths differ."""
    single = records.filter("segment is null").select("record_id", "type", "page_id", "url", "digest", "refers_to", "total", "block", F.lit(True).alias("complete"))
    first = F.col("segment") == 1
    of_first = [F.max(F.when(first, F.col(c))).alias(c) for c in ("type", "page_id", "url", "digest", "refers_to")]
    groups = records.filter("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("record_id")).agg(
        *of_first, F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    joined = groups.withColumn("block", _complete(F.col("parts"), F.col("total"))).drop("parts")
    return single.unionByName(joined.withColumn("complete", F.col("block").isNotNull()))


def payloads(records: DataFrame) -> DataFrame:
    """``records`` with ``payload``: the block without HTTP head and transfer framing; null for revisits and incomplete records."""
    names = [c for c in records.columns if c not in ("block", "payload")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for kind, block in zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1)):
                if kind != "response" or not block.is_valid:
                    out.append(None)
                    continue
                head, _, body = block.as_py().partition(b"\r\n\r\n")
                out.append(unchunked(body) if b"\r\ntransfer-encoding: chunked" in head.lower() else body)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], pa.array(out, pa.binary())], names=[*names, "payload"])

    return records.select(*names, F.col("type").alias("_type"), "block").mapInArrow(run, records.select(names).schema.add("payload", "binary"))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, type, digest, refers_to, total, complete and payload of every record, segments joined."""
    return payloads(reassembled(read_records(spark, path)))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to a new archive and reads it back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    One row per row of ``pages``; columns other than page_id, url and html are ignored; an empty table gives no rows.
    Digest and size of a response are taken from the payload read, those of a revisit from its record.
    """
    spark = pages.sparkSession
    path = folder(spark, "archive")
    write_archive(pages, path)
    read = read_archive(spark, path)
    response = F.col("type") == "response"
    return read.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("total")).cast("long").alias("payload_bytes"),
        F.when(response, F.sha2("payload", 256)).otherwise(F.substring_index("digest", ":", -1)).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.regexp_extract("refers_to", "<urn:page-id:(-?[0-9]+)>", 1).try_cast("long").alias("refers_to"))
