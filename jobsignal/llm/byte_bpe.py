"""Byte-level BPE encoding and decoding of whole texts.

Pre-tokens come from the automaton scan of ``pretokens``. Their slices feed a merge cache: each distinct slice is
merged once per cache generation, and whole batches are expanded with array arithmetic. The byte end of every
token is kept next to its id, so decoding can be checked and slices of a text be traced to tokens.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignal.llm.common import text_of
from jobsignal.llm.pretokens import pretokens

# Slices kept by a worker before the cache starts anew, and code points handled at once; both bound memory only.
CACHED_SLICES = 200_000
CHUNK_CHARS = 500_000
# From this many parts on a heap finds the next pair; shorter slices are scanned.
HEAP_PARTS = 128


@functools.lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank of a rank file (base64 and number per line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def token_table(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all tokens joined, and start and length of each id."""
    ranks = load_ranks(path)
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    tokens = [b""] * len(lengths)
    for token, rank in ranks.items():
        tokens[rank], lengths[rank] = token, len(token)
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank is merged, leftmost first, until none is left."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    if len(piece) >= HEAP_PARTS:
        return _merge_long(piece, ranks)
    none = len(ranks) + 1
    cuts = list(range(len(piece) + 1))
    pairs = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
    while pairs and (low := min(pairs)) < none:
        i = pairs.index(low)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(piece[cuts[i]:cuts[i + 2]], none)
        if i:
            pairs[i - 1] = ranks.get(piece[cuts[i - 1]:cuts[i + 1]], none)
    return [ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """``merge`` in n log n steps: parts in a linked list, pairs in a heap by rank and place; stale pairs are skipped."""
    n = len(piece)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    dead = bytearray(n)

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            end = after[after[i]]
            rank = ranks.get(piece[i:end])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end))

    while heap:
        _, i, end = heapq.heappop(heap)
        if dead[i] or after[i] >= n or after[after[i]] != end:
            continue
        dead[after[i]] = 1
        after[i] = end
        if end < n:
            before[end] = i
        offer(i)
        offer(before[i])
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i:after[i]]])
        i = after[i]
    return ids


class MergeCache:
    """Ids of the distinct slices seen so far, stored end to end."""

    def __init__(self, path: str) -> None:
        self.ranks = load_ranks(path)
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.ends = array("I"), array("q", [0])

    def places(self, slices: list[str]) -> np.ndarray:
        if len(self.place) > CACHED_SLICES:
            self.clear()
        for piece in set(slices).difference(self.place):
            self.place[piece] = len(self.place)
            self.ids.extend(merge(piece.encode("utf-8", "surrogatepass"), self.ranks))
            self.ends.append(len(self.ids))
        return np.fromiter(map(self.place.__getitem__, slices), np.int64, len(slices))

    def expand(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices one after the other, and the number of ids of each."""
        ends = np.array(self.ends, np.int64)
        starts, counts = ends[:-1][places], np.diff(ends)[places]
        return np.array(self.ids, np.uint32)[ranges(starts, counts)], counts


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start and count, one after the other."""
    shift = starts - (np.cumsum(counts) - counts)
    return np.repeat(shift, counts) + np.arange(counts.sum())


def cuts(text: str, limit: int = CHUNK_CHARS) -> Iterator[str]:
    """Parts of a very long text. Before the first blank of a run a token always starts, whatever came earlier."""
    start = 0
    while len(text) - start > limit:
        at = text.rfind(" ", start + 1, start + limit)
        while at > start and text[at - 1].isspace():
            at -= 1
        if at <= start:
            break  # no such place: the rest stays whole
        yield text[start:at]
        start = at
    yield text[start:]


def encode_texts(texts: list[str], cache: MergeCache) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, and the number of ids of each text."""
    if len(texts) == 1 and len(texts[0]) > CHUNK_CHARS:
        parts = [encode_texts([part, ""], cache)[0] for part in cuts(texts[0])]
        return np.concatenate(parts), np.array([sum(map(len, parts))], np.int64)
    joined, starts, ends, owner = pretokens(texts)
    slices = [joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    ids, counts = cache.expand(cache.places(slices))
    return ids, np.bincount(owner, weights=counts, minlength=len(texts)).astype(np.int64)


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows hold ``counts`` consecutive values each, little-endian."""
    ends = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=ends[1:])
    little = np.ascontiguousarray(values, values.dtype.newbyteorder("<"))
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(little)]).cast(pa.binary())


def chunks(texts: Iterable[str], limit: int = CHUNK_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``limit`` code points together; a longer text stands alone."""
    chunk, size = [], 0
    for text in texts:
        if chunk and size + len(text) > limit:
            yield chunk
            chunk, size = [], 0
        chunk.append(text)
        size += len(text) + 1
    if chunk:
        yield chunk


def encoded_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """key, n_tokens, ids and token_ends of batches of keys and texts."""
    cache, (_, _, lengths) = MergeCache(path), token_table(path)  # a cache per task: idle workers hold none
    for batch in batches:
        keys, at = batch.column(0), 0
        for part in chunks(t.as_py() for t in batch.column(1)):
            ids, counts = encode_texts(part, cache)
            ends = np.cumsum(lengths[ids])
            first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64)
            base = np.where(first > 0, ends[np.maximum(first, 1) - 1], 0) if len(ends) else np.zeros(len(counts), np.int64)
            offsets = (ends - np.repeat(base, counts)).astype(np.uint32)
            yield pa.RecordBatch.from_arrays(
                [keys.slice(at, len(part)), pa.array(counts), binaries(ids, counts), binaries(offsets, counts)],
                names=[batch.schema.names[0], "n_tokens", "ids", "token_ends"])
            at += len(part)


def decoded_batches(batches: Iterator[pa.RecordBatch], path: str, out: str) -> Iterator[pa.RecordBatch]:
    """Batches that end in ids and token ends, with ``out`` in place of those two: the bytes of the ids."""
    table, starts, lengths = token_table(path)
    for batch in batches:
        n, decoded = batch.num_columns - 2, []
        for row, marks in zip(batch.column(n), batch.column(n + 1)):
            if not row.is_valid:
                decoded.append(None)
                continue
            tokens = np.frombuffer(row.as_buffer(), "<u4")
            size = lengths[tokens]
            if not np.array_equal(np.cumsum(size), np.frombuffer(marks.as_buffer(), "<u4")):
                raise ValueError("token ends and ids disagree")
            decoded.append(table[ranges(starts[tokens], size)].tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(decoded, pa.binary())], names=[*batch.schema.names[:n], out])


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_tokens, ids and token_ends of every row of ``df``.

    ``ids`` and ``token_ends`` hold little-endian unsigned 32-bit integers: the token ids, and where each token ends
    in the UTF-8 bytes of the text. No special tokens. A null text is the empty text: no ids. Rows that repeat
    are each encoded; a null key stays null; other columns are ignored; an empty table gives no rows.
    """
    kept = df.select(F.col(key), text_of(text).alias("_text"))
    return kept.mapInArrow(lambda batches: encoded_batches(batches, path),
                           f"`{key}` {df.schema[key].dataType.simpleString()}, n_tokens long, ids binary, token_ends binary")


def decode(df: DataFrame, path: str, ids: str = "ids", ends: str = "token_ends", out: str = "decoded") -> DataFrame:
    """The columns of ``df`` without ``ids`` and ``ends``, and ``out``: the bytes of its ids.

    Every token must end where the encoder said; else the task fails. Null ids give null bytes.
    """
    rest = [c for c in df.columns if c not in (ids, ends, out)]
    schema = df.select(rest).schema.add(out, "binary")
    return df.select(*rest, ids, ends).mapInArrow(lambda batches: decoded_batches(batches, path, out), schema)


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the bytes they decode to.

    ``encode`` and ``decode`` run batch by batch in one pass, so a task has one Python worker and not one for each.
    """
    kept = df.select("doc_id", text_of().alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoded = (pa.RecordBatch.from_arrays([*b.columns[:3], *b.columns[2:]], names=["doc_id", "n_tokens", "ids", "_ids", "_ends"])
                   for b in encoded_batches(batches, path))
        return decoded_batches(encoded, path, "decoded")

    both = kept.mapInArrow(run, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary")
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
