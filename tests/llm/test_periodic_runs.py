"""Periodic runs against a brute-force search over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from jobsignal.llm.periodic_runs import digests, periodic_runs, repeated_tail, runs_of, split_rare

COLUMNS = "doc_id long, text string"


def brute(words):
    """Runs as (start, length, period): every stretch kept equal by a period, unless a smaller one covers it."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and not any(
                    all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def own(words):
    rows, _, _ = runs_of([words])
    return [tuple(r[1:]) for r in rows.tolist()]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_small_alphabets(words):
    assert own(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"e"]), min_size=1, max_size=7), st.integers(1, 9)), max_size=6))
def test_planted_repeats(parts):
    words = [w for unit, times in parts for w in unit * times]
    assert own(words) == brute(words)


def test_texts_of_a_batch_stay_apart():
    texts = [[b"a"] * 5, [b"a"] * 5, [b"a", b"b"] * 4, [], [b"x"] * 6]
    rows, _, kept = runs_of(texts)
    assert rows.tolist() == [[2, 0, 8, 2], [4, 0, 6, 1]]
    assert kept.tolist() == [True] * 10 + [True] * 2 + [False] * 6 + [True] + [False] * 5


def test_splitting_recurs():
    # x splits the text; then b is too rare on the left, and a on the right of the next parts
    words = "a b a b x a b a b y a a a a a a b b".split()
    codes = {w: i for i, w in enumerate(sorted(set(words)))}
    ids = np.array([codes[w] for w in words])
    place, segment = split_rare(ids, np.zeros(len(ids), np.int64))
    assert place.tolist() == [10, 11, 12, 13, 14, 15] and set(segment.tolist()) == {0}


def texts():
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choice("abcdefgh") for _ in range(pick.randrange(120)))) for i in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \n\t "), (1003, "la " * 5), (1004, "la " * 6), (1005, "é  " * 8), (7, "twice"), (7, "twice")]
    rows += [(2000, " ".join(f"w{i % 700}" for i in range(9000)) + " tail"), (None, "x y " * 9)]
    return rows


def expected(doc_id, text):
    words = [w for w in (text or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, old = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        words = [old[i] if i < a else old[a + (i - a) % p] for i in range(n)]
    runs = brute(words) if n < 2000 else None
    if runs is None:
        return None
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_against_brute_force(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], COLUMNS + ", runs string")
    got = digests(periodic_runs(docs, repeated_tail))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = sorted(map(tuple, got.collect()), key=str)
    want = sorted(((i, *e) for i, t in rows if (e := expected(i, t))), key=str)
    assert [r for r in found if r[0] != 2000] == want
    long = next(r for r in found if r[0] == 2000)
    assert long[1:5] == (1, 0, 9000, 700)
    assert sum(1 for i, t in rows if i is not None and zlib.crc32(str(i).encode()) % 10 == 0) > 20


def test_very_long_text(spark):
    words = [f"w{i % 30_011}" for i in range(300_000)]
    row = periodic_runs(spark.createDataFrame([(1, " ".join(words))], COLUMNS)).first()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 30_011)] and row.collapsed == " ".join(words[:30_011])


def test_empty_table(spark):
    assert digests(periodic_runs(spark.createDataFrame([], COLUMNS))).collect() == []


@pytest.mark.parametrize("n", [1, 5, 40])
def test_tail_of_short_texts(n):
    words = [b"%d" % i for i in range(n)]
    for doc_id in range(300):
        assert len(repeated_tail(doc_id, words)) == n
