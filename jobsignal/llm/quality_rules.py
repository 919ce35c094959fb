"""Quality rules with host-level verdicts.

Every text is measured once. Failures of the document rules are summed per host (here: the source), each host's
rate is shrunk towards the corpus by a beta prior fitted to all hosts, and a host whose shrunk rate is too high
takes its remaining documents with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignal.llm.common import small, staged, text_of

# Document rules: at least so many words; at most this percentage of words in repeated windows.
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 20, 30, 8
# A host is rejected above this shrunk rate of failures.
MAX_HOST_RATE = 0.5

SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\r\x0b\x0c"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_KIND = np.zeros(256, np.uint8)  # 1: code point starts here, 2: blank, 4: symbol
_KIND[[b for b in range(256) if b & 0xC0 != 0x80]] = 1
_KIND[list(BLANKS)] |= 2
_KIND[list(SYMBOLS)] |= 4


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more in the text.

    Window ids are built by doubling: equal pairs of equal halves get equal ids, so no window is hashed.
    """
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    width = 1
    while width < window:
        half = len(ids) - width
        pairs = ids[:half] * np.int64(len(words)) + ids[width:]
        _, ids = np.unique(pairs, return_inverse=True)
        width *= 2
    twice = np.bincount(ids)[ids] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:len(twice)] += twice
    edges[window:window + len(twice)] -= twice
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    """MEASURES of one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=8)
    lines = [line for line in raw.split(b"\n") if line.strip(BLANKS)]
    return len(words), int(kinds[1] + kinds[5]), int(kinds[5]), len(lines) - len(set(lines)), repeated_words(words)


def measured(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """The columns of ``df`` and the MEASURES of its text, named with ``prefix``; a null text has no words."""
    names = [prefix + m for m in MEASURES]
    rest = [c for c in df.columns if c not in names]
    schema = T.StructType([*df.select(rest).schema.fields, *(T.StructField(n, T.LongType()) for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py()) for t in batch.column(len(rest))]
            columns = zip(*found) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in columns)], names=[*rest, *names])

    return df.select(*rest, text_of(text).alias("_text")).mapInArrow(run, schema)


def failed(prefix: str = "") -> Column:
    """Whether the document rules fail."""
    words, repeated = F.col(prefix + "n_words"), F.col(prefix + "n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * words)


def host_verdicts(rows: DataFrame, host: Column, bad: Column, limit: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, rate, rejected: one row per host, null being a host of its own.

    The prior is a beta distribution with the mean and spread of the hosts' own rates (method of moments): with
    mean m and variance v of the rates, its strength is m (1 - m) / v - 1, at least 1 and at most the mean number
    of documents of a host; without spread it is that number. A rate is (failures + m * strength) / (documents +
    strength). Counts are summed before the shuffle, so a host with a third of all rows costs one row per task.
    """
    counts = rows.groupBy(host.alias("host")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(bad.cast("long")).alias("n_failed"))
    counts = staged(counts, "host-counts")
    rate = F.col("n_failed") / F.col("n_docs")
    prior = counts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"), F.avg("n_docs").alias("size"))
    m, v, size = prior.first() or (None, None, None)
    if m is None:
        m, v, size = 0.0, 0.0, 1.0
    strength = size if v <= 0 else min(max(m * (1 - m) / v - 1, 1.0), size)
    shrunk = (F.col("n_failed") + F.lit(m * strength)) / (F.col("n_docs") + F.lit(strength))
    return counts.withColumn("rate", shrunk).withColumn("rejected", F.col("rate") > limit)


def with_verdict(rows: DataFrame, host: str, bad: Column, out: str) -> DataFrame:
    """``rows`` with boolean ``out``: false where ``bad``, or where the host is rejected."""
    refused = small(host_verdicts(rows, F.col(host), bad).filter("rejected").select(F.col("host").alias("_host"), F.lit(True).alias("_refused")))
    return rows.join(refused, F.col(host).eqNullSafe(F.col("_host")), "left").withColumn(
        out, ~bad & F.col("_refused").isNull()).drop("_host", "_refused")


def quality_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, the MEASURES, base_failed and kept of every row.

    A null or empty text has no words and fails; repeated rows are judged alike; a null host is a host of its own;
    other columns are ignored; an empty table gives no rows.
    """
    rows = staged(measured(docs.select("doc_id", F.col(host).alias("_source"), "text")).drop("text"), "rule-measures")
    return with_verdict(rows, "_source", failed(), "kept").select("doc_id", *MEASURES, failed().alias("base_failed"), "kept")


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass the rules and whose host does; all columns as they were."""
    verdicts = host_verdicts(measured(docs.select(F.col(host).alias("_source"), "text")).drop("text"), F.col("_source"), failed())
    refused = small(verdicts.filter("rejected").select(F.col("host").alias("_host")))
    rows = measured(docs, prefix="_rule_").filter(~failed("_rule_")).select(docs.columns)
    return rows.join(refused, F.col(host).eqNullSafe(F.col("_host")), "left_anti")
