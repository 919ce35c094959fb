"""Whitening against an eigendecomposition in memory."""

import math

import numpy as np
import pytest

from jobsignal.llm.common import staged
from jobsignal.llm.whitening import _added, deviations, solve_triangular, whiten

COLUMNS = "vec_id long, embedding array<float>, n string, x long, task string"


def plain(rows, count=4):
    """vec_id -> (deviation, whitened values up to sign), n, shares; by numpy's eigh over the distinct vectors."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in kept]
    width = max(set(sizes), key=lambda w: (sizes.count(w), w))
    kept = [(i, v) for i, v in kept if len(v) == width]
    fit = np.array(sorted({tuple(v) for _, v in kept}), float)
    n, sums = len(fit), [sum(c) for c in zip(*{tuple(v) for _, v in kept})]
    centred = fit - fit.mean(axis=0)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    trace = (centred ** 2).sum() / n
    out = []
    for i, v in kept:
        white = (np.array(v) - np.array(sums) / n) @ axes
        out.append((i, sum((n * c - s) ** 2 for c, s in zip(v, sums)), white))
    return n, values, trace, out


def check(spark, rows, tolerance=1e-9):
    got = whiten(spark.createDataFrame([(i, v, "a", 1, "b") for i, v in rows], COLUMNS))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = got.collect()
    n, values, trace, want = plain(rows)
    k = len(values)
    assert len(got) == k * len(want)
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.vec_id, r.deviation) for r in got if r.component == 1), key=key) == sorted(((i, d) for i, d, _ in want), key=key)
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    for c in range(k):
        mine = [r for r in got if r.component == c + 1]
        if trace == 0:
            assert all(r.explained is None and r.whitened is None for r in mine)
            continue
        assert all(math.isclose(r.explained, values[c] / trace, rel_tol=1e-6, abs_tol=1e-12) for r in mine)
        if values[c] < 1e-9 * values[0]:
            assert all(r.whitened is None for r in mine)
            continue
        theirs = {(i, d): w[c] / math.sqrt(values[c]) for i, d, w in want}
        mine = {(r.vec_id, r.deviation): r.whitened for r in mine}
        sign = 1 if sum(mine[p] * theirs[p] for p in theirs) > 0 else -1
        assert max(abs(sign * mine[p] - theirs[p]) for p in theirs) < tolerance
    return got


def vectors(n, width, seed, spread=None):
    random = np.random.default_rng(seed)
    spread = np.geomspace(3, 0.2, width) if spread is None else spread
    turn, _ = np.linalg.qr(random.normal(size=(width, width)))
    return (random.normal(size=(n, width)) * spread @ turn + random.normal(size=width)).astype(np.float32).tolist()


def test_against_eigh(spark):
    rows = list(enumerate(vectors(500, 12, 1)))
    rows += [(1000 + i, rows[i % 20][1]) for i in range(300)]  # copies count once
    rows += [(5, rows[5][1]), (None, rows[7][1])]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 11 + [None]), (2003, [1.0] * 11 + [float("nan")]), (2004, [float("-inf")] * 12), (2005, [1.0] * 5), (2006, [-0.0] * 12)]
    got = check(spark, rows)
    assert got[0].identity_error < 1e-10


def test_conditioned_badly(spark):
    # large common offset and directions of very different size
    got = check(spark, list(enumerate((np.array(vectors(400, 10, 2, np.geomspace(4e2, 0.05, 10))) + 1e3).tolist())), 1e-6)
    assert got[0].identity_error < 1e-6


@pytest.mark.parametrize("rows", [
    [(i, [float(i), 2.0 * i, 5.0, 0.5 * (i % 7)]) for i in range(60)],  # rank two
    [(i, [float(i % 5)] * 6) for i in range(60)],  # rank one
    [(i, [1.0, 2.0, 3.0]) for i in range(9)],  # one distinct vector
    [(i, [float(i * i)]) for i in range(9)],  # one entry
    [(0, [1.0, 2.0, 3.0, 4.0, 5.0]), (1, [2.0, 1.0, 0.0, 4.0, 5.0])],
])
def test_directions_without_variance(spark, rows):
    check(spark, rows)


def test_given_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert check(spark, rows)[0].identity_error < 1e-10


def test_nothing_to_fit(spark):
    assert whiten(spark.createDataFrame([], COLUMNS)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, "", 0, ""), (2, [], "", 0, "")], COLUMNS)).collect() == []


def test_tree_of_sums(spark):
    parts = spark.range(5000, numPartitions=7).selectExpr("id as task", "array(1D, cast(id as double)) as part")
    assert _added(parts, False).tolist() == [5000, sum(range(5000))]
    assert _added(staged(parts.limit(0), "none"), False).tolist() == []


def test_triangular_solve():
    upper = np.triu(np.random.default_rng(1).normal(size=(6, 6))) + 4 * np.eye(6)
    columns = np.random.default_rng(2).normal(size=(6, 3))
    assert np.allclose(upper.T @ solve_triangular(upper, columns), columns)


def test_deviations_beyond_a_long():
    x = np.array([[1, 2], [2**40, -2**40]])
    assert deviations(x, 3, [3, 6]) == [0, None]
    assert deviations(np.array([[2**30, 0]]), 2, [0, 0]) == [2**62]
