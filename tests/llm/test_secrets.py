"""Secret scan against a plain scan of each text."""

import bisect
import hashlib
import itertools
import math
import random
import re
import string
import time

import pytest
from pyspark.sql import functions as F

from jobsignal.llm.secrets import randomness, running, scan

BASE = {
    "assign": (re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
}
PIECES = ["token", "TOKEN", "password", "Api_Key", "apikey", "secret", "paſswd", "=", ":", " ", "'", '"', "\n", "\t", "é", "🙂", "AKIA",
          "A1B2C3D4E5F6G7H8", "0123abcd", "deadbeefdeadbeef", "x", "abc", "K", "."]


def base_spans(text):
    found = []
    for k, (pattern, group, least) in enumerate(BASE.values()):
        found += [(m.start(), k, m.end()) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    return [f"{list(BASE)[k]}:{a}:{b}" for a, k, b in sorted(found)]


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(5)
    return ["".join(pick.choices(PIECES, k=pick.randrange(0, 30))) for _ in range(800)] + ["", "token=token: abcdefgh", "token = ab token=abcdef"]


def test_base_spans(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(-1, None, None)], "doc_id long, text string, spans string")
    rows = {r.doc_id: r for r in scan(df).collect()}
    assert len(rows) == len(texts) + 1 and rows[-1].spans == ""
    for i, text in enumerate(texts):
        want = base_spans(text)
        assert rows[i].base_spans == ",".join(want), text
        assert rows[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [rows[i].n_assign, rows[i].n_access, rows[i].n_hex] == [sum(w.startswith(k) for w in want) for k in BASE]


def test_random_tokens_stand_out(spark):
    pick = random.Random(3)
    keys = ["".join(pick.choices(string.ascii_letters + string.digits, k=pick.choice([32, 40, 64]))) for _ in range(300)]
    words = ["".join(w.capitalize() for w in pick.choices(["the", "reading", "counter", "value", "manager", "session"], k=9)) + "2" for _ in range(300)]
    df = spark.createDataFrame([(i, f"see {w} here") for i, w in enumerate(keys + words)], "doc_id long, text string")
    rows = {r.doc_id: r for r in scan(df).collect()}
    assert sum(rows[i].n_random for i in range(300)) >= 270
    assert sum(rows[i].n_random for i in range(300, 600)) <= 15
    first = next(i for i in range(300) if rows[i].n_random)
    assert rows[first].spans == f"random:4:{4 + len(keys[first])}"


def test_keys_are_tested_in_their_own_alphabet(spark):
    pick = random.Random(4)
    draw = lambda chars, n: "".join(pick.choices(chars, k=n))
    upper_hex, base62 = "0123456789ABCDEF", string.ascii_letters + string.digits

    def uuid():
        x = draw("0123456789abcdef", 32)
        return "-".join([x[:8], x[8:12], x[12:16], x[16:20], x[20:]])

    makers = [lambda: ("signing_key=", draw(upper_hex, 32), ""), lambda: ("session=", draw(upper_hex.lower(), 20), ""), lambda: ("id ", uuid(), ""),
              lambda: ("storage_account_access_key=", draw(base62, 24), ""), lambda: ("", draw(upper_hex, 32), ""), lambda: ("é session=", uuid(), ""),
              lambda: ("key ", draw(string.ascii_lowercase, 40), ""), lambda: ("sig=", draw(base62, 42) + "==", ""), lambda: ("", draw(base62, 32), "=name")]
    rows = [(i, *makers[i % len(makers)]()) for i in range(900)]
    words = ["_".join(pick.choices(["the", "reading", "counter", "value", "manager", "session"], k=5)) + "=2" for _ in range(200)]
    df = spark.createDataFrame([(i, "".join(parts)) for i, *parts in rows] + list(enumerate(words, 2000)), "doc_id long, text string")
    found = {r.doc_id: r for r in scan(df).collect()}
    hits = [0] * len(makers)
    for i, before, key, _ in rows:
        wanted = f"random:{len(before)}:{len(before) + len(key)}"
        assert found[i].spans in ("", wanted), (rows[i], found[i].spans)
        hits[i % len(makers)] += found[i].spans == wanted
    assert min(hits) >= 90, hits
    assert not any(found[i].n_random for i in range(2000, 2200))


def plain_probability(symbols, size):
    """The battery by plain formulas: chi-squared, runs and serial test, joined by Fisher."""
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    n = len(symbols)
    chi = sum((symbols.count(k) - n / size) ** 2 / (n / size) for k in range(size))
    spread = 2 / (9 * (size - 1))
    ps = [tail(((chi / (size - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))]
    high = [2 * s >= size for s in symbols]
    n1, n2 = sum(high), n - sum(high)
    variance = 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
    turns = sum(a != b for a, b in zip(high, high[1:]))
    ps.append(min(2 * tail(abs(turns - 2 * n1 * n2 / n) / math.sqrt(variance)), 1) if variance > 0 else 1e-12)
    middle = (size - 1) / 2
    serial = sum((a - middle) * (b - middle) for a, b in zip(symbols, symbols[1:])) / ((size * size - 1) / 12 * math.sqrt(n - 1))
    ps.append(min(2 * tail(abs(serial)), 1))
    x = -sum(math.log(max(p, 1e-300)) for p in ps)
    return math.exp(-x) * (1 + x + x * x / 2)


def test_battery_against_plain_formulas(spark):
    pick = random.Random(8)
    rows = []
    for size in (16.0, 26.0, 32.0, 36.0, 62.0, 64.0):
        for n in (20, 33, 80, 400):
            rows += [(size, [pick.randrange(int(size)) for _ in range(n)]), (size, [pick.randrange(1 + int(size) // 3) for _ in range(n)]),
                     (size, [k % int(size) for k in range(n)]), (size, [int(size) - 1] * n)]
    df = spark.createDataFrame(rows, "size double, symbols array<int>")
    for r in df.select("size", "symbols", randomness(F.col("symbols"), F.col("size")).alias("p")).collect():
        want = plain_probability(r.symbols, int(r["size"]))
        assert math.isclose(r.p, want, rel_tol=1e-3, abs_tol=1e-6), (r, want)


def test_running_results(spark):
    pick = random.Random(6)
    rows = [([pick.randrange(0, 50) for _ in range(n)],) for n in (0, 1, 2, 15, 16, 17, 300, 5000)]
    df = spark.createDataFrame(rows, "v array<long>")
    for r in df.select("v", running(F.col("v"), lambda x, y: x + y).alias("s"), running(F.col("v"), F.greatest).alias("m")).collect():
        assert r.s == list(itertools.accumulate(r.v)) and r.m == list(itertools.accumulate(r.v, max))


def test_tokens_within_base_spans(spark):
    """Random keys inside assignments, next to them and across many matches of one long text."""
    pick = random.Random(7)
    draw = lambda n: "".join(pick.choices(string.ascii_letters + string.digits, k=n))
    parts = []
    for i in range(30_000):
        parts.append([f"token={draw(40)}", f"key {draw(40)}", "AKIA" + "A1" * 10, "deadbeef" * 4, "some plain words"][i % 5])
    text = " ".join(parts)
    assert len(text) > 700_000
    started = time.time()
    row = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.time() - started < 60
    want = base_spans(text)
    assert row.base_spans == ",".join(want)
    inside = [tuple(map(int, w.split(":")[1:])) for w in want]
    starts = [a for a, _ in inside]
    added = [tuple(map(int, s.split(":")[1:])) for s in row.spans.split(",") if s.startswith("random")]
    assert len(added) == row.n_random > 5000
    for a, b in added:
        at = bisect.bisect_right(starts, a)
        assert text[a - 4:a] == "key " and not any(b <= e for _, e in inside[max(at - 3, 0):at])


def test_empty_table(spark):
    assert scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0
