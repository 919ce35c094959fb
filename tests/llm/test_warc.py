"""WARC archives: round trips, segments, damage and edge cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from jobsignal.llm import warc
from jobsignal.llm.common import folder

LONG = "é\r\n\r\nWARC/1.1\r\n" * 3000
PAGES = [(1, "http://a", LONG, "x"), (2, None, LONG, "x"), (3, "http://c\r\nX: y", "short", None), (4, "d", "short", "x"),
         (5, "e", None, "x"), (None, "f", LONG, "x"), (1, "http://a", LONG, "x"), (7, "g", "y" * 100, "x"), (6, "h", "y" * 100, "x")]


def expected():
    out = []
    for page_id, _, html, _ in PAGES:
        payload = (html or "").encode()
        first = min(p for p, _, h, _ in PAGES if h == html and p is not None)
        again = len(payload) >= 100 and page_id is not None and page_id != first
        out.append((page_id, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string, digest string")


def test_round_trip(pages):
    assert sorted(map(tuple, warc.archive_round_trip(pages).collect()), key=repr) == expected()
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_small_segments_over_many_files(spark, pages):
    path = folder(spark, "archive")
    warc.write_archive(pages, path, segment_bytes=1000, records_per_file=3)
    records = warc.read_records(spark, path)
    assert records.filter("type = 'continuation'").count() > 60
    got = warc.read_archive(spark, path).filter("type = 'response'")
    assert got.filter("not complete").count() == 0
    assert {r.payload.decode() for r in got.collect()} == {LONG, "short", "", "y" * 100}


def test_missing_and_wrong_segments(spark, pages):
    path = folder(spark, "archive")
    warc.write_archive(pages.filter("page_id = 1").limit(1), path, segment_bytes=1000)
    records = warc.read_records(spark, path)
    assert warc.reassembled(records.filter("segment is null or segment <> 3")).filter("not complete and block is null").count() == 1
    assert warc.reassembled(records.withColumn("total", F.col("total") + 1)).filter("not complete").count() == 1
    assert warc.reassembled(records.orderBy(F.rand(1))).filter("complete").count() == 1


def test_framing():
    for size in (0, 1, 4096, 9000):
        body = bytes(range(256)) * 40
        assert warc.unchunked(warc.chunked(body[:size])) == body[:size]
    assert warc.unchunked(b"3;x=1\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_files_are_archives(spark, pages):
    path = folder(spark, "archive")
    warc.write_archive(pages, path)
    data = b"".join(warc.unpacked(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect())
    kinds = [f["warc-type"] for f, _ in warc.parse(data)]
    assert set(kinds) == {"response", "revisit", "continuation"} and kinds.count("revisit") == 2
