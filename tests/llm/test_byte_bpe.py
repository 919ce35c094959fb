"""Byte-level BPE against the tokenizer library, and its edge cases."""

import hashlib
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from jobsignal.llm import byte_bpe
from jobsignal.llm.common import tokenizer_file
from jobsignal.llm.pretokens import PATTERN, pretokens

PATH = tokenizer_file("byte_bpe_50k.tiktoken")
ALPHABET = list("abcde stmdrvl 'éß12९ \n\t\r!?…—　  \x1c") + ["'ll", "'re", "'ve", "  ", "漢", "🙂", "é", "Ⅷ"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.load_ranks(PATH), special_tokens={})


def random_texts(n, seed):
    pick = random.Random(seed)
    return ["".join(pick.choices(ALPHABET, k=pick.randrange(0, 40))) for _ in range(n)]


def encoded(texts):
    ids, counts = byte_bpe.encode_texts(texts, byte_bpe.MergeCache(PATH))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


def test_same_ids_as_the_library(library):
    texts = random_texts(4000, 1) + ["", "'", "''s", " 's", "it's'll", "'re're", "'rest", "<|endoftext|>", "a" * 300, "ab" * 900]
    assert encoded(texts) == [library.encode_ordinary(t) for t in texts]


def test_every_code_point_has_the_class_of_the_library(library):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}a" for c in points[i:i + 4000]) for i in range(0, len(points), 4000)]
    differ = [i for i, (a, b) in enumerate(zip(encoded(texts), map(library.encode_ordinary, texts))) if a != b]
    assert not differ


def test_long_runs_and_cuts(library):
    text = ("word " * 9 + "x" * 70_000 + "  \n y") * 12
    assert len(list(byte_bpe.cuts(text, 100_000))) > 5
    assert encoded([text])[0] == library.encode_ordinary(text)


def test_slices_cover_the_texts():
    texts = random_texts(500, 2)
    joined, starts, ends, owner = pretokens(texts)
    parts = [""] * len(texts)
    for a, b, i in zip(starts, ends, owner):
        parts[i] += joined[a:b]
    assert parts == texts


def test_rows(spark, library):
    rows = [(1, "It's fine.", "x"), (2, None, "x"), (3, "", None), (None, "a b", "x"), (1, "It's fine.", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted((tuple(r) for r in byte_bpe.round_trip(df, PATH).collect()), key=repr)
    want = []
    for key, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        want.append((key, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert byte_bpe.round_trip(df.limit(0), PATH).count() == 0


def test_token_ends(spark):
    row = byte_bpe.encode(spark.createDataFrame([(1, "né e")], "doc_id long, text string"), PATH).first()
    assert np.frombuffer(row.token_ends, "<u4")[-1] == len("né e".encode())


def test_round_trip_needs_one_worker_a_task(spark):
    """Each Python pass of a stage keeps a worker of its own beside the others."""
    df = spark.createDataFrame([(1, "né e'll " * 70), (2, None), (None, "a  b\n")], "doc_id long, text string")
    found = byte_bpe.round_trip(df, PATH)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    parts = byte_bpe.decode(byte_bpe.encode(df, PATH).withColumn("ids_sha256", F.sha2("ids", 256)), PATH)
    assert parts.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded"]
    parts = parts.select(*parts.columns[:3], F.sha2("decoded", 256))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, parts.collect()), key=repr)
