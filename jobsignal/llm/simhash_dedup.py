"""Near-duplicates by SimHash fingerprints, linked by a self-join of binary tries.

A fingerprint bit is set if it is set in more than half of the hashes of a text's word shingles. Distinct fingerprints
are the leaves of a trie. Pairs of its nodes are traversed together from the root; each level adds a differing bit or
none, and a pair with more than MOST_BITS of them is pruned with all leaves below. What is left at the leaves are links.

Tries are spread over the cluster by what a link must have in common: cut into m blocks, two linked fingerprints agree
in at least m - MOST_BITS of them. There is one trie for each choice of blocks and each value of them; it holds the
fingerprints with that value, those blocks being its first levels. ``block_count`` takes as many blocks as keep the
tries of random fingerprints small. A trie with more than UNIT_LEAVES leaves (one large group of near copies) is taken
apart by Spark: node pairs are joined level by level (STEP bits at once) with the sizes of their children, until the
pairs left are small. There too, pairs are pruned whose leaves have one label already: near copies that follow each
other in the order of a trie are linked and labelled first, so a large group doesn't meet itself pair by pair. Within
a task the same holds: links found so far are united at each level.

Links are given as members of found components, at most one per leaf and trie, never as all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from jobsignal.llm.byte_bpe import chunks
from jobsignal.llm.common import small, staged, text_of
from jobsignal.llm.near_dedup import components

SHINGLE_WORDS, SEED, MOST_BITS = 4, 42, 4
BITS = 64
CHUNK_BYTES = 1_000_000
# Fingerprints per trie that ``block_count`` aims at, most leaves of a node pair for one task, and levels per join.
MEAN_LEAVES, UNIT_LEAVES, STEP = 4096, 8192, 6
# Leaves and node pairs a task holds at once, and products of leaves below which pairs are compared directly.
TASK_LEAVES, TASK_PAIRS, DIRECT = 65_536, 400_000, 32

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --- fingerprints ---

def fingerprints(texts: list[bytes]) -> np.ndarray:
    """The fingerprint of each text; zero without words."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    for i, raw in enumerate(texts):
        words = raw.translate(_LOWER).split()
        if not words:
            continue
        line = b" ".join(words)
        ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
        starts = [0, *(e + 1 for e in ends[:-1])]
        span = min(SHINGLE_WORDS, len(words))
        own = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[span - 1:])]
        hashes += own
        counts[i] = len(own)
    result = np.zeros(len(texts), np.uint64)
    full = counts > 0
    if full.any():
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, (np.cumsum(counts) - counts)[full], axis=0, dtype=np.int32)
        set_bits = 2 * sums > counts[full, None]
        result[full] = np.packbits(set_bits, axis=1, bitorder="little").view("<u8").ravel()
    return result


def _fingerprint_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for part in chunks((t.as_py() for t in batch.column(1)), CHUNK_BYTES):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(fingerprints(part).view(np.int64))], names=["doc_id", "fp"])
            at += len(part)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a long) of every row."""
    return docs.select(F.col("doc_id").cast("long"), text_of().cast("binary").alias("_text")).mapInArrow(_fingerprint_rows, "doc_id long, fp long")


# --- tries over blocks of bits ---

def block_count(n: int) -> int:
    """Blocks for ``n`` distinct fingerprints: the fewest for which random ones meet at most MEAN_LEAVES of a kind."""
    return next((m for m in range(MOST_BITS + 1, 2 * MOST_BITS) if n <= MEAN_LEAVES << shared_bits(m)), 2 * MOST_BITS)


def shared_bits(m: int) -> int:
    """Bits that every choice of m - MOST_BITS blocks has at least."""
    return (BITS // m) * (m - MOST_BITS)


def layouts(m: int) -> list[list[tuple[int, int]]]:
    """For each trie kind the blocks (lowest bit, width) from the top of its keys down, the agreeing ones first."""
    widths = [BITS // m + (i < BITS % m) for i in range(m)]
    blocks = [(sum(widths[:i]), width) for i, width in enumerate(widths)]
    return [[blocks[i] for i in chosen] + [b for i, b in enumerate(blocks) if i not in chosen] for chosen in combinations(range(m), m - MOST_BITS)]


def _key(layout: list[tuple[int, int]]) -> Column:
    """The bits of ``fp`` in the order of ``layout``."""
    parts, low = [], BITS
    for start, width in layout:
        low -= width
        block = F.shiftrightunsigned("fp", start).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        parts.append(F.shiftleft(block, low))
    return reduce(Column.bitwiseOR, parts)


def _fp(keys: np.ndarray, layout: list[tuple[int, int]]) -> np.ndarray:
    """Fingerprints of ``keys``."""
    fps, low = np.zeros(len(keys), np.uint64), BITS
    for start, width in layout:
        low -= width
        fps |= (keys >> np.uint64(low) & np.uint64((1 << width) - 1)) << np.uint64(start)
    return fps


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("key", BITS - depth)


# --- the join within a task ---

def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after a[i] and b[i] were linked; a label is the smallest place of its component."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        parent = np.arange(len(label))
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(further := parent[parent], parent):
            parent = further
        label = parent[label]


def _uniform(label: np.ndarray):
    """A function that tells which ranges [a, b) have one label."""
    changes = np.zeros(len(label), np.int64)
    changes[1:] = np.cumsum(label[1:] != label[:-1])
    return lambda a, b: changes[a] == changes[b - 1]


def join_tries(keys: np.ndarray, roots: np.ndarray) -> np.ndarray:
    """Label of each key after the node pairs of ``roots`` were traversed.

    ``roots`` has rows of the ranges [a, b) and [c, d) of both nodes in ``keys``, their depth and the bits they differ
    in; keys are ascending within a node. Ranges of a node with itself are equal.
    """
    label = np.arange(len(keys))
    zeros: dict[int, np.ndarray] = {}

    def split(a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Where the children with bit 1 start."""
        if depth not in zeros:
            zeros[depth] = np.r_[0, np.cumsum(keys >> np.uint64(BITS - 1 - depth) & np.uint64(1) ^ np.uint64(1))].astype(np.int32)
        return a + zeros[depth][b] - zeros[depth][a]

    stack = [(int(depth), roots[roots[:, 4] == depth][:, [0, 1, 2, 3, 5]]) for depth in np.unique(roots[:, 4])]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > TASK_PAIRS:
            stack += [(depth, part) for part in np.array_split(pairs, 2)]
            continue
        a, b, c, d, differ = pairs.T
        one = _uniform(label)
        done = one(a, b) & one(c, d) & (label[a] == label[c])
        a, b, c, d, differ = a[~done], b[~done], c[~done], d[~done], differ[~done]
        linked = differ + (BITS - depth) <= MOST_BITS  # whatever bits follow
        if linked.any():
            first, size = np.r_[a[linked], c[linked]], np.r_[b[linked] - a[linked], d[linked] - c[linked]]
            label = unite(label, np.repeat(first, size), _ranges(first, size))
            label = unite(label, a[linked], c[linked])
        few = ~linked & ((b - a) * (d - c) <= DIRECT)
        if few.any():
            w = (d - c)[few]
            size = (b - a)[few] * w
            offset = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            w = np.repeat(w, size)
            x, y = np.repeat(a[few], size) + offset // w, np.repeat(c[few], size) + offset % w
            near = np.bitwise_count(keys[x] ^ keys[y]) <= MOST_BITS
            label = unite(label, x[near], y[near])
        rest = ~linked & ~few
        a, b, c, d, differ = a[rest], b[rest], c[rest], d[rest], differ[rest]
        if not len(a):
            continue
        m, k = split(a, b, depth), split(c, d, depth)
        itself = a == c
        children = [(a, m, c, k, differ), (m, b, k, d, differ), (a, m, k, d, differ + 1), (m[~itself], b[~itself], c[~itself], k[~itself], (differ + 1)[~itself])]
        below = np.concatenate([np.stack(child, axis=1) for child in children])
        below = below[(below[:, 0] < below[:, 1]) & (below[:, 2] < below[:, 3]) & (below[:, 4] <= MOST_BITS)]
        below = below[(below[:, 0] != below[:, 2]) | (below[:, 1] - below[:, 0] > 1)]  # a leaf with itself
        if len(below):
            stack.append((depth + 1, below))
    return label


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _join_units(m: int):
    """Arrow function: rows of kind, depth, low, high, keys -> members (a, b) of components found."""
    kinds = layouts(m)

    def settle(units: list[tuple[int, int, int, int, np.ndarray]]) -> pa.RecordBatch:
        arrays, roots, at, owners = [], [], 0, []
        for kind, depth, low, high, keys in units:
            keys = np.sort(keys)
            cut = int(np.searchsorted(keys, np.uint64((low + 1) << (BITS - depth)))) if low != high else len(keys)
            other = at + cut if low != high else at
            roots.append((at, at + cut, other, at + len(keys), depth, (low ^ high).bit_count()))
            arrays.append(keys)
            owners.append(np.full(len(keys), kind))
            at += len(keys)
        keys, owner = np.concatenate(arrays), np.concatenate(owners)
        label = join_tries(keys, np.array(roots, np.int64))
        moved = np.flatnonzero(label != np.arange(len(label)))
        a, b = np.zeros(len(moved), np.uint64), np.zeros(len(moved), np.uint64)
        for kind in np.unique(owner[moved]):
            own = owner[moved] == kind
            a[own], b[own] = _fp(keys[moved[own]], kinds[kind]), _fp(keys[label[moved[own]]], kinds[kind])
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units, held = [], 0
            for i in range(batch.num_rows):
                kind, depth, low, high = (batch.column(j)[i].as_py() for j in range(4))
                keys = batch.column(4)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                units.append((kind, depth, low, high, keys))
                held += len(keys)
                if held >= TASK_LEAVES:
                    yield settle(units)
                    units, held = [], 0
            if units:
                yield settle(units)

    return run


# --- tries over the cluster ---

def _neighbours(m: int):
    """Arrow function: links between neighbours in the order of sorted rows of kind and key."""
    kinds = layouts(m)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, keys = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            near = (kind[1:] == kind[:-1]) & (np.bitwise_count(keys[1:] ^ keys[:-1]) <= MOST_BITS)
            for k in np.unique(kind[1:][near]):
                own = np.flatnonzero(near & (kind[1:] == k))
                a, b = (_fp(keys[at], kinds[k]).view(np.int64) for at in (own, own + 1))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def links_of(fps: DataFrame, unit_leaves: int = UNIT_LEAVES) -> DataFrame:
    """Members (a, b) of linked fingerprints; ``fps`` is a written table of distinct ``fp``.

    Their components are those of all links of at most MOST_BITS differing bits.
    """
    m = block_count(fps.count())
    depth, kinds = shared_bits(m), layouts(m)
    keyed = F.explode(F.array(*(F.struct(F.lit(i).alias("kind"), _key(layout).alias("key")) for i, layout in enumerate(kinds))))
    keys = fps.select(keyed.alias("k")).select("k.*")
    node = ["kind", _prefix(depth).alias("node")]
    hot = staged(keys.groupBy(*node).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > unit_leaves), "hot-tries")
    tries = keys.select(*node, "key").join(small(hot.select("kind", "node")), ["kind", "node"], "left_anti")
    tries = tries.groupBy("kind", "node").agg(F.collect_list("key").alias("keys")).filter(F.size("keys") > 1)
    units = [tries.select("kind", F.lit(depth).alias("depth"), F.col("node").alias("low"), F.col("node").alias("high"), "keys")]
    found = []
    if not hot.isEmpty():
        hot_keys = staged(keys.withColumn("node", _prefix(depth)).join(small(hot.select("kind", "node")), ["kind", "node"], "left_semi").drop("node"), "hot-keys")
        more, first = _hot_units(hot, hot_keys, m, depth, unit_leaves)
        units += more
        found.append(first)
    joined = [unit.mapInArrow(_join_units(m), "a long, b long") for unit in units]
    return staged(reduce(DataFrame.union, [*joined, *found]).distinct(), "fingerprint-links")


def _hot_units(hot: DataFrame, keys: DataFrame, m: int, depth: int, unit_leaves: int) -> tuple[list[DataFrame], DataFrame]:
    """Units of small node pairs that large tries were taken apart into, and links that were found before."""
    kinds = layouts(m)
    ordered = keys.select("kind", "key").repartitionByRange("kind", "key").sortWithinPartitions("kind", "key")
    first = staged(ordered.mapInArrow(_neighbours(m), "a long, b long").distinct(), "neighbours")
    labels = components(first.select(F.col("a").alias("id")).union(first.select("b")).distinct(), first).toDF("fp", "label")
    back = reduce(lambda rest, i: F.when(F.col("kind") == i, _fp_column(kinds[i])).otherwise(rest), range(1, len(kinds)), _fp_column(kinds[0]))
    named = keys.withColumn("fp", back).join(labels, "fp", "left").select("kind", "key", F.coalesce("label", "fp").alias("label"))
    keys = staged(named, "labelled-keys")
    units = []
    pairs = hot.select("kind", F.col("node").alias("low"), F.col("node").alias("high"), F.lit(0).alias("differ"))
    while True:
        tops = small(pairs.select("kind", F.col("low").alias("parent")).union(pairs.select("kind", F.col("high").alias("parent"))).distinct())
        inner = keys.withColumn("parent", _prefix(depth)).join(tops, ["kind", "parent"], "left_semi")
        depth += STEP
        kids = staged(inner.groupBy("kind", "parent", _prefix(depth).alias("node")).agg(
            F.count(F.lit(1)).alias("n"), F.min("label").alias("least"), F.max("label").alias("most")), "trie-nodes")
        low, high = (kids.toDF(*(f"{c}_{side}" for c in kids.columns)) for side in ("low", "high"))
        met = (pairs.join(low, (F.col("kind") == F.col("kind_low")) & (F.col("low") == F.col("parent_low")))
               .join(high, (F.col("kind") == F.col("kind_high")) & (F.col("high") == F.col("parent_high"))))
        differ = F.bit_count(F.col("node_low").bitwiseXOR(F.col("node_high")))
        one = (F.col("least_low") == F.col("most_high")) & (F.col("least_high") == F.col("most_low")) & (F.col("least_low") == F.col("most_low"))
        n = F.col("n_low") + F.when(F.col("node_low") == F.col("node_high"), 0).otherwise(F.col("n_high"))
        met = met.filter((differ <= MOST_BITS) & ((F.col("low") != F.col("high")) | (F.col("node_low") <= F.col("node_high"))) & ~one & (n > 1))
        met = staged(met.select("kind", F.col("node_low").alias("low"), F.col("node_high").alias("high"), differ.alias("differ"), n.alias("n")), "node-pairs")
        ready = met.filter(F.col("n") <= unit_leaves).withColumn("unit", F.monotonically_increasing_id())
        sides = ready.select("unit", "kind", "low", "high", F.explode(F.array_distinct(F.array("low", "high"))).alias("node"))
        rows = keys.select("kind", "key", _prefix(depth).alias("node")).join(staged(sides, "units"), ["kind", "node"])
        gathered = rows.groupBy("unit", "kind", "low", "high").agg(F.collect_list("key").alias("keys"))
        units.append(gathered.select("kind", F.lit(depth).alias("depth"), "low", "high", "keys"))
        pairs = met.filter(F.col("n") > unit_leaves).drop("n")
        if pairs.isEmpty():  # at the latest when nodes have room for fewer leaves
            return units, first


def _fp_column(layout: list[tuple[int, int]]) -> Column:
    parts, low = [], BITS
    for start, width in layout:
        low -= width
        parts.append(F.shiftleft(F.shiftrightunsigned("key", low).bitwiseAND(F.lit((1 << width) - 1).cast("long")), start))
    return reduce(Column.bitwiseOR, parts)


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id of every row.

    Fingerprints that differ in at most MOST_BITS bits are linked; component_id is the smallest doc_id reachable, itself
    included. Null and empty texts have fingerprint zero and are linked like any other. Repeated rows share a
    fingerprint and hence a component; a repeated doc_id with several texts gives one row each. A row without doc_id
    links like any other, but can't be the smallest; its component is null if no linked row has an id. Other columns are
    ignored; an empty table gives no rows.
    """
    signs = staged(fingerprinted(docs), "fingerprints")
    owners = staged(signs.groupBy("fp").agg(F.min("doc_id").alias("owner"), F.count(F.lit(1)).alias("n")), "distinct-fingerprints")
    links = links_of(owners.select("fp"))
    linked = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    labels = staged(components(linked, links).toDF("fp", "label").join(owners, "fp"), "fingerprint-labels")
    least = labels.groupBy("label").agg(F.min("owner").alias("component_id"))
    moved = labels.join(least, "label").select("fp", "component_id")
    # fingerprints of one row that are linked with nothing need no table: their component is the row itself
    rest = owners.filter("n > 1").join(moved, "fp", "left_anti").select("fp", F.col("owner").alias("component_id"))
    shared = small(staged(moved.union(rest), "components"))
    named = signs.join(shared.withColumn("shared", F.lit(True)), "fp", "left")
    return named.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.when(F.col("shared"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
