"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are measured where the documents are. The trees are fitted on a bounded sample of labelled rows, chosen by
a hash of the id; they are kept as flat arrays (one row per tree, children of node i at 2i + 1 and 2i + 2), so a batch of
documents walks all trees level by level with array look-ups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal.llm.common import hashed_sample, small, text_of
from jobsignal.llm.quality_rules import BLANKS, repeated_words

# Labelled rows that are fitted at most: those with the smallest hashes of their ids.
SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS = 60, 4, 48
RATE, L2, LEAST_WEIGHT = 0.2, 1.0, 2.0
KEEP_FROM = 0.3

STATISTICS = (
    "log_words", "mean_word", "spread_word", "long_words", "distinct_words", "top_word", "pair_repeats", "repeated_windows",
    "symbols", "digits", "uppercase", "non_ascii", "punctuation", "ending_words", "capital_words", "lines_per_word",
    "repeated_lines", "bars", "exclamations", "byte_entropy",
)


def statistics(text: str) -> list[float]:
    """STATISTICS of one text; all zero without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    lengths = np.fromiter(map(len, words), np.float64, n)
    seen = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    share = counts[counts > 0] / size
    of = lambda chars: counts[list(chars)].sum() / size
    return [
        float(np.log1p(n)), lengths.mean(), lengths.std(), (lengths > 20).mean(), len(seen) / n, max(seen.values()) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, repeated_words(words) / n,
        of(b"#*$%&|<>@^~{}[]\\_=+"), of(b"0123456789"), of(range(65, 91)), of(range(128, 256)), of(b".,;:!?'\"()-"),
        sum(w[-1:] in b".!?" for w in words) / n, sum(w.isupper() and len(w) > 1 for w in words) / n, len(lines) / n,
        (len(lines) - len(set(lines))) / len(lines), of(b"|"), of(b"!"), float(-(share * np.log2(share)).sum()),
    ]


@dataclass
class Trees:
    """Flat trees: split feature and value of each inner node, value of each leaf, and the score they start from."""

    features: np.ndarray
    values: np.ndarray
    leaves: np.ndarray
    start: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.features))[None, :]
        node = np.zeros((len(x), len(self.features)), np.int64)
        for _ in range(DEPTH):
            right = x[rows, self.features[trees, node]] > self.values[trees, node]
            node = 2 * node + 1 + right
        return self.start + self.leaves[trees, node - (2**DEPTH - 1)].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margins(x)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for the log loss: each level of a tree is split by histograms of gradients over binned statistics."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    trees = Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), float(np.log(mean / (1 - mean))))
    if len(y) == 0 or y.min() == y.max():
        return trees
    edges = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    bins, width = BINS + 1, x.shape[1]
    margin = np.full(len(y), trees.start)
    grown = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        gradient, weight = p - y, p * (1 - p)
        features, values = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, here = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * width + np.arange(width)) * bins + binned
            g, h = (np.bincount(slot.ravel(), np.repeat(v, width), here * width * bins).reshape(here, width, bins)
                    for v in (gradient, weight))
            left_g, left_h = g.cumsum(axis=2)[:, :, :-1], h.cumsum(axis=2)[:, :, :-1]
            all_g, all_h = g.sum(axis=2, keepdims=True), h.sum(axis=2, keepdims=True)
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + L2) + right_g**2 / (right_h + L2) - all_g**2 / (all_h + L2)
            gain[(left_h < LEAST_WEIGHT) | (right_h < LEAST_WEIGHT)] = 0
            best = gain.reshape(here, -1).argmax(axis=1)
            for i, at in enumerate(best):
                feature, cut = divmod(int(at), bins - 1)
                if gain[i, feature, cut] > 1e-9 and cut < len(edges[feature]):
                    features[first + i], values[first + i] = feature, edges[feature][cut]
            node = 2 * node + 1 + (x[np.arange(len(y)), features[node]] > values[node])
        leaf = node - inner
        total_g, total_h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, weight, leaves)
        step = -RATE * total_g / (total_h + L2)
        margin += step[leaf]
        grown.append((features, values, step))
    trees.features, trees.values, trees.leaves = map(np.array, zip(*grown))
    return trees


def measured(rows: DataFrame) -> DataFrame:
    """doc_id, quality and the statistics of the text as an array ``x``, of labelled rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "quality", "x"])

    return rows.select(F.col("doc_id").cast("long"), F.col("quality").cast("int"), text_of().alias("_text")).mapInArrow(
        run, "doc_id long, quality int, x array<double>")


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Trees fitted on at most ``sample_rows`` labelled doc_ids that are not held out.

    A doc_id counts once: with its largest label, and of several texts with the one of the smallest hash.
    """
    known = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = hashed_sample(known, "doc_id", sample_rows)
    rows = docs.select("doc_id", text_of().alias("text")).join(small(sample), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("t")).select("doc_id", "quality", "t.text")
    found = sorted(map(tuple, measured(rows).collect()), key=repr)  # one row per doc_id of the sample
    x = np.array([r[2] for r in found], np.float64).reshape(-1, len(STATISTICS))
    return fit(x, np.array([float(r[1] > 0) for r in found]))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    A null text counts as empty; texts without words get the score of all-zero statistics. Repeated rows are scored
    alike; a row without doc_id is not held out; other columns are ignored; an empty table gives no rows. Without
    labels the score is 0.5.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t.as_py()) for t in batch.column(1)], np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(trees.scores(x))], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long"), text_of().alias("_text")).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= KEEP_FROM).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
