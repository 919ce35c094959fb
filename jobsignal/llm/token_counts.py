"""Token counts under a unigram tokenizer, by dynamic programming over a trie of pre-tokens.

The best segmentation of a pre-token is the one of highest total score. Its forward score at a position depends on the
bytes before it only, so distinct pre-tokens are inserted into a trie of bytes and the score is computed once per node:
the maximum over all vocabulary pieces that end there of the score at the piece's start plus the piece's own score. The
pieces that end at a node are found by walking back along its path through a trie of the reversed pieces, which ends at
the first byte that no piece has there. The terminal node of a pre-token stores its token count and score; those are
kept by pre-token, each distinct one of a chunk is looked up once, and texts are added up by array arithmetic.

Piece scores come from the ranks of a public rank file: -ln(rank + RANK_SHIFT), the logarithm of a Zipf frequency up to
a constant. All single bytes are pieces, so every text has a segmentation.
"""

from __future__ import annotations

import functools
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignal.llm.byte_bpe import CHUNK_CHARS, chunks, cuts, load_ranks
from jobsignal.llm.common import text_of
from jobsignal.llm.pretokens import pretokens

RANK_SHIFT = 256
# Nodes of a task's trie before it starts anew, pre-tokens whose results are kept, and bytes of a pre-token that is
# kept at all; they bound memory only.
TRIE_NODES, KEPT_PRETOKENS, KEPT_BYTES = 500_000, 500_000, 64


@functools.lru_cache(maxsize=2)
def piece_scores(path: str) -> tuple[dict[bytes, float], int]:
    """Score of each piece, and the length of the longest."""
    scores = {piece: -math.log(rank + RANK_SHIFT) for piece, rank in load_ranks(path).items()}
    return scores, max(map(len, scores))


@functools.lru_cache(maxsize=2)
def reversed_pieces(path: str) -> tuple[dict[int, int], list[float]]:
    """Trie of the pieces read backward: (node << 8 | byte) -> node, and the score of the piece that a node stands for (0: none)."""
    child, score = {}, [0.0]
    for piece, own in piece_scores(path)[0].items():
        node = 0
        for byte in reversed(piece):
            key = node << 8 | byte
            node = child.get(key, 0)
            if not node:
                node = child[key] = len(score)
                score.append(0.0)
        score[node] = own
    return child, score


class Trie:
    """Forward scores and token counts of all prefixes of the pre-tokens seen so far.

    Node 0 is the root; ``child`` maps (node, byte) to a node.
    """

    def __init__(self, path: str) -> None:
        self.back, self.own = reversed_pieces(path)
        self.clear()
        self.place: dict[str, int] = {}
        self.counts, self.scores = array("q"), array("d")

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.score, self.count = [0.0], [0]

    def places(self, pieces: list[str]) -> np.ndarray:
        """Where the results of the pre-tokens are in ``counts`` and ``scores``."""
        if len(self.place) > KEPT_PRETOKENS:  # the older half goes
            kept = list(self.place.items())[len(self.place) // 2:]
            self.counts, self.scores = array("q", [self.counts[i] for _, i in kept]), array("d", [self.scores[i] for _, i in kept])
            self.place = {piece: i for i, (piece, _) in enumerate(kept)}
        for piece in set(pieces).difference(self.place):
            raw = piece.encode("utf-8", "surrogatepass")
            count, score = self.insert(raw) if len(raw) <= KEPT_BYTES else self.forward(raw)
            self.place[piece] = len(self.counts)
            self.counts.append(count)
            self.scores.append(score)
        return np.fromiter(map(self.place.__getitem__, pieces), np.int64, len(pieces))

    def look_up(self, piece: str) -> tuple[int, float]:
        """Token count and score of a pre-token."""
        place = int(self.places([piece])[0])
        return self.counts[place], self.scores[place]

    def step(self, raw: bytes, path: list[int]) -> int:
        """A new node for raw[:len(path)], below those of all shorter prefixes; of equal scores the fewest tokens count."""
        back, own, score, count = self.back, self.own, self.score, self.count
        best, least, node = -math.inf, 0, 0
        for start in range(len(path) - 1, -1, -1):
            node = back.get(node << 8 | raw[start])
            if node is None:
                break
            piece = own[node]
            if piece:
                before = path[start]
                total, tokens = score[before] + piece, count[before] + 1
                if total > best or total == best and tokens < least:
                    best, least = total, tokens
        score.append(best)
        count.append(least)
        return len(score) - 1

    def insert(self, raw: bytes) -> tuple[int, float]:
        """Count and score of a pre-token; nodes that the trie lacks are added."""
        if len(self.score) > TRIE_NODES:
            self.clear()
        child, node, path = self.child, 0, [0]
        for byte in raw:
            key = node << 8 | byte
            node = child.get(key)
            if node is None:
                node = child[key] = self.step(raw, path)
            path.append(node)
        return self.count[node], self.score[node]

    def forward(self, raw: bytes) -> tuple[int, float]:
        """The same for a long pre-token; its nodes are not kept."""
        kept = len(self.score)
        path = [0]
        for _ in raw:
            path.append(self.step(raw, path))
        found = self.count[-1], self.score[-1]
        del self.score[kept:], self.count[kept:]
        return found


def count_texts(texts: list[str], trie: Trie) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens, tokens and score of each text."""
    if len(texts) == 1 and len(texts[0]) > CHUNK_CHARS:
        parts = [count_texts([part, ""], trie) for part in cuts(texts[0])]
        return tuple(np.array([sum(p[i][0] for p in parts)]) for i in range(3))
    joined, starts, ends, owner = pretokens(texts)
    places = trie.places([joined[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    counts, scores = np.array(trie.counts, np.int64)[places], np.array(trie.scores, np.float64)[places]
    sums = [np.bincount(owner, w, len(texts)) for w in (None, counts, scores)]
    return sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2]


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pretokens, n_tokens and log_score (rounded to six digits) of every row.

    A null or empty text has no tokens and score 0. Repeated rows are counted alike; other columns are ignored; an
    empty table gives no rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(path)  # one per task: idle workers hold none
        for batch in batches:
            at = 0
            for part in chunks(t.as_py() for t in batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), *map(pa.array, count_texts(part, trie))],
                                                 names=["doc_id", "n_pretokens", "n_tokens", "log_score"])
                at += len(part)

    counted = docs.select(F.col("doc_id").cast("long"), text_of().alias("_text")).mapInArrow(
        run, "doc_id long, n_pretokens long, n_tokens long, log_score double")
    return counted.withColumn("log_score", F.round("log_score", 6))
