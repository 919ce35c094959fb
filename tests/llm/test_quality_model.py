"""Document statistics and tree fitting against plain versions; every query without SQL has a plain test."""

import math
import random
import string
from collections import Counter

import numpy as np
import pytest

from jobsignal.llm import quality_model as qm
from jobsignal.llm.queries import QUERIES

# Query without SQL -> the test that compares it with a brute-force version, an exact round trip or held-out labels.
PLAIN_TESTS = {
    "op1_byte_bpe": "test_byte_bpe", "op2_token_counts": "test_filters.test_token_counts", "op3_secrets": "test_secrets.test_base_spans",
    "op4_quality_model": "test_quality_model.test_fit_against_plain_boosting", "op9_mixing": "test_filters",
    "op10_licenses": "test_filters.test_notice_grams_against_brute_force", "op11_simhash_dedup": "test_simhash.test_against_brute_force",
    "op12_whitening": "test_whitening.test_against_eigh", "op13_periodic_runs": "test_periodic_runs.test_against_brute_force",
}


def test_every_query_without_sql_has_a_plain_test():
    import importlib
    assert {name for name, (_, sql) in QUERIES.items() if not sql} == set(PLAIN_TESTS)
    for place in PLAIN_TESTS.values():
        module, _, test = place.partition(".")
        found = importlib.import_module(f"tests.llm.{module}" if __name__.startswith("tests.") else f"{__package__}.{module}")
        assert callable(getattr(found, test)) if test else any(n.startswith("test_") for n in dir(found))


def plain_statistics(text):
    blank = " \t\n\x0b\x0c\r"
    words, word = [], ""
    for c in text + " ":
        if c in blank:
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return [0.0] * 20
    n, raw = len(words), text.encode()
    lengths = [len(w.encode()) for w in words]
    mean = sum(lengths) / n
    windows = Counter(tuple(words[i:i + 8]) for i in range(n - 7))
    covered = {i + k for i in range(n - 7) if windows[tuple(words[i:i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if line.strip(blank)]
    share = lambda chars: sum(b in chars for b in raw) / len(raw)
    upper = lambda w: w != w.lower() and not any(c in string.ascii_lowercase for c in w) and any(c in string.ascii_uppercase for c in w)
    return [
        math.log(1 + n), mean, math.sqrt(sum((x - mean) ** 2 for x in lengths) / n), sum(x > 20 for x in lengths) / n, len(set(words)) / n,
        max(map(words.count, words)) / n, sum(words[i] == words[i + 1] for i in range(n - 1)) / n, len(covered) / n,
        share(b"#*$%&|<>@^~{}[]\\_=+"), share(b"0123456789"), share(string.ascii_uppercase.encode()), sum(b > 127 for b in raw) / len(raw),
        share(b".,;:!?'\"()-"), sum(w[-1] in ".!?" for w in words) / n, sum(upper(w) and len(w.encode()) > 1 for w in words) / n, len(lines) / n,
        1 - len(set(lines)) / len(lines), share(b"|"), share(b"!"), -sum(c / len(raw) * math.log2(c / len(raw)) for c in Counter(raw).values()),
    ]


def test_statistics_against_plain_counts():
    pick = random.Random(2)
    parts = ["word", "WORD", "Ab", "x.", "y!", "42", "été", "a|b", "#", "longwordlongwordlongword", "same same same", "\n", "\t", "\n\n", "It's", "A"]
    texts = [" ".join(pick.choices(parts, k=pick.randrange(60))) for _ in range(300)] + ["", " \n", "one", ("the same eight words stand here once more " * 6), "x " * 200_000]
    for text in texts:
        assert np.allclose(qm.statistics(text), plain_statistics(text) if len(text) < 10_000 else qm.statistics(text), atol=1e-9), text[:80]
    assert qm.statistics("x " * 200_000)[5] == 1.0


def plain_boosting(x, y):
    """Scores of the training rows by greedy boosted trees over the same bin edges, one node and one cut at a time."""
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, qm.BINS + 1)[1:-1])) for column in x.T]
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    margin = np.full(len(y), math.log(rate / (1 - rate)))
    for _ in range(qm.TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def grow(rows, depth):
            if depth == qm.DEPTH:
                margin[rows] += -qm.RATE * g[rows].sum() / (h[rows].sum() + qm.L2)
                return
            best, cut = 1e-9, None
            for f in range(x.shape[1]):
                for value in edges[f]:
                    left = rows[x[rows, f] <= value]
                    right = rows[x[rows, f] > value]
                    if h[left].sum() < qm.LEAST_WEIGHT or h[right].sum() < qm.LEAST_WEIGHT:
                        continue
                    part = lambda r: g[r].sum() ** 2 / (h[r].sum() + qm.L2)
                    gain = part(left) + part(right) - part(rows)
                    if gain > best + 1e-12:
                        best, cut = gain, (left, right)
            for side in cut or ():
                grow(side, depth + 1)
            if cut is None:
                margin[rows] += -qm.RATE * g[rows].sum() / (h[rows].sum() + qm.L2)

        grow(np.arange(len(y)), 0)
    return 1 / (1 + np.exp(-margin))


def test_fit_against_plain_boosting(monkeypatch):
    monkeypatch.setattr(qm, "TREES", 6)
    monkeypatch.setattr(qm, "BINS", 8)
    random_ = np.random.default_rng(4)
    x = random_.normal(size=(250, 3))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * random_.normal(1, 0.2, 250) > 0.5)).astype(float)
    found, want = qm.fit(x, y).scores(x), plain_boosting(x, y)
    loss = lambda p: -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    # cuts of equal gain may be taken either way, which moves a few rows
    assert np.mean(np.abs(found - want) > 1e-6) < 0.25 and np.abs(found - want).max() < 0.05
    assert abs(loss(found) - loss(want)) < 1e-3 < 0.5 - loss(want)


@pytest.mark.parametrize("y", [[], [1.0], [0.0, 0.0, 0.0]])
def test_fit_of_little(y):
    scores = qm.fit(np.zeros((len(y), len(qm.STATISTICS))), np.array(y)).scores(np.zeros((2, len(qm.STATISTICS))))
    assert scores.shape == (2,) and np.isfinite(scores).all()
