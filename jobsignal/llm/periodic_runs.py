"""Periodic runs of words, found by recursive frequency splitting and a lag scan.

A run is a stretch of words with smallest period q and at least MIN_WORDS words and MIN_REPEATS * q words that no
neighbouring word extends. Each of its words occurs MIN_REPEATS times in it, so a word that occurs less often within a
segment is in no run there and splits the segment. The parts are counted anew, until no segment changes; segments too
short for a run are given up. Most texts have no segment left.

The lag scan goes over the surviving segments, a class of lags at a time. In a class of lags from q to 1.5 q a run has
room for a window of twice the largest lag and one more lag, so every window of the run recurs after exactly the run's
period, and windows recur nowhere sooner: the distance to the next equal window is the smallest period there. Equal
windows are equal numbers, built by doubling, so the scan is exact and takes n log n steps for any number of lags. A
run is a stretch of windows with one distance.

Whole batches of texts are handled at once by array arithmetic; texts are never combined with each other.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal.llm.byte_bpe import chunks
from jobsignal.llm.common import text_of

MIN_WORDS, MIN_REPEATS = 6, 4
CHUNK_BYTES = 1_000_000
# Rounds of splitting. Only odd texts need more; splitting narrows the scan and never decides, so it may end early.
MOST_ROUNDS = 64

Rewrite = Callable[[int, list[bytes]], list[bytes]]


def split_rare(ids: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that may be in a run, ascending, and their segments' numbers; ``owner`` is the text of each place."""
    place, segment = np.arange(len(ids)), owner
    stable: list[tuple[np.ndarray, np.ndarray]] = []
    many = int(ids.max(initial=0)) + 1
    for _ in range(MOST_ROUNDS):
        _, kind, times = np.unique(segment * many + ids[place], return_inverse=True, return_counts=True)
        often = times[kind] >= MIN_REPEATS
        touched = np.zeros(int(segment.max(initial=-1)) + 1, bool)
        touched[segment[~often]] = True
        calm = ~touched[segment]
        stable.append((place[calm], segment[calm]))
        place, segment = place[often & ~calm], segment[often & ~calm]
        if not len(place):
            break
        segment = _numbered(place, segment)
        long = np.bincount(segment)[segment] >= MIN_WORDS
        place, segment = place[long], segment[long]
    else:
        stable.append((place, segment))
    places = [_numbered(*part) for part in stable]
    shifts = np.cumsum([0, *(int(p.max(initial=-1)) + 1 for p in places)])
    place, segment = np.concatenate([p for p, _ in stable]), np.concatenate([p + s for p, s in zip(places, shifts)])
    long = np.bincount(segment)[segment] >= MIN_WORDS if len(segment) else np.zeros(0, bool)
    place, segment = place[long], segment[long]
    order = np.argsort(place)
    return place[order], _numbered(place[order], segment[order])


def _numbered(place: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Numbers from 0 on of the stretches of consecutive places with one old segment."""
    new = np.ones(len(place), bool)
    new[1:] = (np.diff(place) != 1) | (np.diff(segment) != 0)
    return np.cumsum(new) - 1


def _paired(first: np.ndarray, shift: int) -> np.ndarray:
    """A number for each pair of ``first`` at i and at i + shift; pairs beyond the end differ from all others."""
    many, n = int(first.max()) + 1, len(first)
    second = np.arange(many, many + n)
    second[:max(n - shift, 0)] = first[shift:]
    return first * (many + n) + second


def lag_scan(ids: np.ndarray, place: np.ndarray, segment: np.ndarray) -> np.ndarray:
    """Runs within the segments as rows of start place, length and period."""
    if not len(place):
        return np.zeros((0, 3), np.int64)
    sizes = np.bincount(segment)
    line = np.full(len(place) + len(sizes), -1)  # words, and after each segment a mark that equals nothing
    line[np.arange(len(place)) + segment] = ids[place]
    marks = line < 0
    line[marks] = int(ids.max()) + 1 + np.arange(marks.sum())
    where = np.full(len(line), -1)
    where[~marks] = place
    room = np.repeat(sizes, sizes + 1)  # words of the segment that each entry of the line belongs to
    equal, width, found = np.unique(line, return_inverse=True)[1], 1, []
    low = 1
    while True:
        left = room >= max(MIN_WORDS, MIN_REPEATS * low)
        if not left.any():
            break
        if not left.all():
            equal, where, room = equal[left], where[left], room[left]
        high = low * 3 // 2
        window = 2 * high
        while 2 * width <= window:
            equal, width = np.unique(_paired(equal, width), return_inverse=True)[1], 2 * width
        same = _paired(equal, window - width) if window > width else equal
        order = np.argsort(same, kind="stable")
        again = np.flatnonzero(same[order[1:]] == same[order[:-1]])
        at, lag = order[again], order[again + 1] - order[again]
        near = (lag >= low) & (lag <= high)
        at, lag = at[near], lag[near]
        if len(at):
            order = np.argsort(at)
            at, lag = at[order], lag[order]
            new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(lag) != 0)])
            last = np.r_[new[1:], len(at)] - 1
            length = at[last] - at[new] + lag[new] + window
            kept = length >= np.maximum(MIN_WORDS, MIN_REPEATS * lag[new])
            found.append(np.stack([where[at[new]], length, lag[new]], axis=1)[kept])
        low = high + 1
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def runs_of(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of all texts (lists of words): rows of text, start, length and period in this order, where the texts
    start among all words, and which words are kept when each run is cut to its first period."""
    counts = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(counts) - counts
    every = [word for words in texts for word in words]
    codes = {word: i for i, word in enumerate(set(every))}
    ids = np.fromiter(map(codes.__getitem__, every), np.int64, len(every))
    owner = np.repeat(np.arange(len(texts)), counts)
    runs = lag_scan(ids, *split_rare(ids, owner))
    edges = np.zeros(len(every) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    text = owner[runs[:, 0]]
    rows = np.column_stack([text, runs[:, 0] - starts[text], runs[:, 1], runs[:, 2]])
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))], starts, np.cumsum(edges[:-1]) == 0


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """doc_id, runs (array of start, length, period; by start, then period) and collapsed of every row.

    ``collapsed`` joins by one space the words that are left when each run is cut to its first period. ``rewrite``
    changes the words of a text first (called with doc_id and words). A null or empty text has no words, no runs and an
    empty collapsed text. Repeated rows are handled alike, whole texts of any length are scanned; doc_id may be null,
    other columns are ignored; an empty table gives no rows.
    """
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks((t.as_py() for t in batch.column(1)), CHUNK_BYTES):
                keys = batch.column(0).slice(at, len(part))
                texts = [raw.split() for raw in part]
                if rewrite:
                    texts = [rewrite(key, words) for key, words in zip(keys.to_pylist(), texts)]
                rows, starts, kept = runs_of(texts)
                offsets = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1)).astype(np.int32)
                fields = pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in (1, 2, 3)], names=["start", "length", "period"])
                joined = []
                for i, words in enumerate(texts):
                    if offsets[i] < offsets[i + 1]:
                        words = compress(words, kept[starts[i]:starts[i] + len(words)].tolist())
                    joined.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.ListArray.from_arrays(pa.array(offsets), fields).cast(runs_type), pa.array(joined, pa.binary())],
                    names=["doc_id", "runs", "collapsed"])
                at += len(part)

    found = docs.select(F.col("doc_id").cast("long"), text_of().cast("binary").alias("_text")).mapInArrow(
        run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of every tenth text (by checksum of doc_id) with a tail that repeats some of its words.

    With h = crc32(decimal doc_id) and g = h // 10, for h % 10 = 0 each word from a = g % n on is word a + (i - a) % p,
    where p = 1 + (n - a) // (3 + g % 8). Other texts and those without an id stay as they are.
    """
    if doc_id is None or not words:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * (-(-(n - a) // p)))[:n - a]


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period) and checksums of runs and collapsed text."""
    def line(run: Column) -> Column:
        return F.concat_ws(",", run["start"], run["length"], run["period"])

    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.withColumn("best", best)
    period = -F.col("best.period")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        period.alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
