"""Near-duplicates by b-bit MinHash: band candidates, collision-corrected bit estimates, full confirmation.

1. Every text becomes a set of word shingles (64-bit hashes). Texts with equal sets are one class from here on.
2. A class has HASHES minima. Bands of ROWS minima give bucket keys; the low BITS bits of all minima are packed
   into bit planes, so a similarity estimate is a few xor and bit_count operations.
3. In each bucket every class is paired with one head only, another one in each of its bands. Estimates far below the
   threshold drop out; the rest are confirmed on the full shingles of both texts. Confirmed pairs are links.
4. Linked classes get component labels. A bucket is settled if its classes all carry one label. What other buckets may
   still hide are links between labels; all of them have an end outside the bucket's most frequent label. They are found
   by a prefix join of the full shingle sets: a class is listed under its rarest shingles, so many that two linked
   classes must share one. Passages that many texts share are never among the rarest shingles of a text with enough
   words of its own, so buckets made by such passages cost nothing there, and near copies mostly carry one label already.
5. The labels of the final graph are spread back to all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from jobsignal.llm.common import small, staged, text_of

SHINGLE_WORDS, PERCENT = 5, 75
# 32 bands of 4 minima: a pair at the threshold shares no band with probability (1 - 0.75^4)^32 = 5e-6.
BANDS, ROWS = 32, 4
HASHES = 256  # minima of a signature; the bands use the first of them
BITS = 4
# Pairs are dropped unconfirmed below this estimate: five standard deviations under the threshold.
LEAST_ESTIMATE = 0.6
CHUNK_CHARS = 1_000_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_RANDOM = np.random.default_rng(20_240_607)
_FACTORS = _RANDOM.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)
_SHIFTS = _RANDOM.integers(0, 1 << 32, HASHES, np.uint32)
_STEPS = _RANDOM.integers(0, 1 << 63, SHINGLE_WORDS, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, each distinct word hashed once."""
    known = {word: xxh3_64_intdigest(word) for word in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after the other, and their number per text."""
    words, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
        counts[i] = len(own)
        words += own
    hashes = word_hashes(words)
    rolled = np.zeros(max(len(hashes) - SHINGLE_WORDS + 1, 0), np.uint64)
    for k, step in enumerate(_STEPS):
        rolled += hashes[k:k + len(rolled)] * step
    rolled = mixed(rolled)
    sets, start = [], 0
    for n in counts.tolist():
        if n >= SHINGLE_WORDS:
            sets.append(np.unique(rolled[start:start + n - SHINGLE_WORDS + 1]))
        elif n:  # the whole sequence is the only shingle; its length keeps it apart from longer ones
            own = (hashes[start:start + n] * _STEPS[:n]).sum(keepdims=True) + np.uint64(n)
            sets.append(mixed(own))
        else:
            sets.append(np.zeros(0, np.uint64))
        start += n
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.array([len(s) for s in sets], np.int64)


def signatures(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """HASHES minima of each set; all sets have members."""
    starts = np.cumsum(counts) - counts
    low = (values >> np.uint64(32)).astype(np.uint32)
    minima = np.empty((len(counts), HASHES), np.uint32)
    for i in range(HASHES):
        minima[:, i] = np.minimum.reduceat(low * _FACTORS[i] + _SHIFTS[i], starts)
    return minima


def band_keys(minima: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, the band's number mixed in."""
    keys = np.zeros((len(minima), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mixed(keys + minima[:, r:BANDS * ROWS:ROWS].astype(np.uint64) + np.uint64(r + 1))
    return mixed(keys + np.arange(BANDS, dtype=np.uint64))


def packed(minima: np.ndarray) -> np.ndarray:
    """BITS planes of HASHES bits, as 64-bit words: plane by plane the low bits of the remixed minima."""
    bits = mixed(minima.astype(np.uint64)).astype(np.uint8)
    planes = [np.packbits(bits >> b & 1, axis=1) for b in range(BITS)]
    return np.concatenate(planes, axis=1).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from jobsignal.llm.byte_bpe import chunks
    for batch in batches:
        ids, at = batch.column(0), 0
        for texts in chunks((t.as_py() for t in batch.column(1)), CHUNK_CHARS):
            values, counts = shingles(texts)
            full = counts > 0
            starts = (np.cumsum(counts) - counts)[full]
            sums = np.zeros((2, len(texts)), np.uint64)
            bands, planes = np.zeros((len(texts), BANDS), np.int64), np.zeros((len(texts), BITS * HASHES // 64), np.int64)
            if full.any():
                sums[0, full] = np.add.reduceat(values, starts)
                sums[1, full] = np.add.reduceat(mixed(values + np.uint64(1)), starts)
                minima = signatures(values, counts[full])
                bands[full], planes[full] = band_keys(minima).view(np.int64), packed(minima)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.int64())) for x in (bands, planes)]
            yield pa.RecordBatch.from_arrays(
                [ids.slice(at, len(texts)), pa.array(counts), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), *lists],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "planes"])
            at += len(texts)


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, a 128-bit set hash, band keys and packed bits of every row."""
    return docs.select(F.col("doc_id").cast("long"), text_of().alias("_text")).mapInArrow(
        _sign, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, planes array<long>")


def estimate(a: str, b: str) -> Column:
    """Similarity from two packed signatures, corrected for chance agreement of 1 in 2^BITS."""
    words = HASHES // 64
    differ = None
    for w in range(words):
        mask = None
        for plane in range(BITS):
            i = plane * words + w
            bits = F.col(a)[i].bitwiseXOR(F.col(b)[i])
            mask = bits if mask is None else mask.bitwiseOR(bits)
        differ = F.bit_count(mask) if differ is None else differ + F.bit_count(mask)
    chance = 2.0 ** -BITS
    return ((1 - differ / HASHES) - chance) / (1 - chance)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of texts whose full shingle sets are similar enough; the first text's set is reused while it repeats."""
    last, first = None, set()
    for batch in batches:
        keep = []
        for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
            if a != last:
                last, first = a, shingle_set(x.as_py())
            second = shingle_set(y.as_py())
            common = len(first & second)
            keep.append(100 * common >= PERCENT * (len(first) + len(second) - common))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def shingle_set(text: str) -> set:
    """The distinct shingles of a text themselves."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if len(words) < SHINGLE_WORDS:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(SHINGLE_WORDS))))


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of doc_ids whose texts are linked, both texts read in full."""
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
    firsts = small(pairs.select("a").distinct())
    seconds = small(pairs.select("b").distinct())
    left = texts.join(firsts, F.col("id") == F.col("a"), "left_semi").toDF("a", "text_a")
    right = texts.join(seconds, F.col("id") == F.col("b"), "left_semi").toDF("b", "text_b")
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return staged(both.mapInArrow(_confirm, "a long, b long"), "links")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """id and label of each node: the smallest id reachable over ``links`` (a, b).

    Each round takes the smallest label among a node's neighbours and then the label of that label; rounds end
    when no label moves. A node with very many links costs one partial minimum per task.
    """
    edges = staged(links.select("a", "b").union(links.select("b", "a")).toDF("x", "y").distinct(), "edges")
    labels = staged(edges.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")).toDF("id", "label"), "labels")
    while True:
        near = edges.join(labels, F.col("y") == F.col("id")).groupBy("x").agg(F.min("label").alias("near"))
        best = labels.join(near, F.col("id") == F.col("x")).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("id").alias("via"), F.col("label").alias("far"))
        moved = staged(best.join(jump, F.col("label") == F.col("via")).select("id", F.least("label", "far").alias("label"), "old"), "labels")
        labels = moved.select("id", "label")
        if moved.filter("label < old").isEmpty():
            break
    return nodes.join(labels, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def classes(signs: DataFrame) -> DataFrame:
    """One row per distinct non-empty set: the signature of its smallest doc_id."""
    tops = signs.filter("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc_id"))
    rows = signs.join(tops, ["set_a", "set_b", "doc_id"]).dropDuplicates(["set_a", "set_b", "doc_id"])
    return staged(rows.select(F.col("doc_id").alias("id"), "n_shingles", "set_a", "set_b", "bands", "planes"), "classes")


def class_labels(found: DataFrame, docs: DataFrame) -> DataFrame:
    """id and label of every class: the smallest id of its component."""
    buckets = staged(found.select("id", F.explode("bands").alias("bucket")).distinct(), "buckets")
    heads = buckets.groupBy("bucket").agg(F.min_by("id", F.xxhash64("id", "bucket")).alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = staged(buckets.join(heads.select("bucket", "head"), "bucket"), "shared-buckets")
    pairs = rows.filter("id <> head").select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b")).distinct()
    labels = staged(components(found.select("id"), confirmed(_likely(pairs, found), docs)), "class-labels")
    more = _prefix_pairs(_unsettled(rows.join(labels, "id")), found, docs)
    return _merged(labels, confirmed(more, docs))


def _unsettled(rows: DataFrame) -> DataFrame:
    """id, label and apart of the classes in buckets with several labels, from rows of bucket, id, head and label.

    A class is apart if in one of these buckets it is not the head, which was paired with all others, and has another
    label than most. Labels are counted per bucket before they are compared, however large the bucket.
    """
    rows = staged(rows, "bucket-labels")
    mains = (rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket")
             .agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("main"), F.count(F.lit(1)).alias("labels")).filter("labels > 1"))
    apart = (F.col("id") != F.col("head")) & (F.col("label") != F.col("main"))
    return staged(rows.join(mains, "bucket").groupBy("id", "label").agg(F.max(apart).alias("apart")), "unsettled")


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            values, counts = shingles([batch.column(1)[i].as_py()])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column(0)[i].as_py(), len(values)), pa.int64()), pa.array(values.view(np.int64))], names=["id", "shingle"])


def _prefix_pairs(classes: DataFrame, found: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) of ``classes`` with different labels, one of them apart, that may be linked.

    All sets are put into one order of shingles (here: frequency, then value). Two linked sets of n shingles each have
    one in common among the first n - ceil(0.75 n) + 1, and at the first one in common enough shingles follow in both
    sets to make up the overlap that their sizes ask for. Shingles of a single text are not listed, as they can't be
    shared, but count as places; so a text with many shingles of its own meets few others.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("_text")).join(small(classes.select("id")), "id", "left_semi")
    rows = staged(texts.mapInArrow(_shingle_rows, "id long, shingle long").distinct(), "shingles")
    counts = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = Window.partitionBy("id")  # one text's shingles
    ranked = (rows.join(counts, "shingle", "left").withColumn("place", F.row_number().over(own.orderBy(F.coalesce("n", F.lit(1)), "shingle")))
              .withColumn("size", F.count(F.lit(1)).over(own)))
    listed = ranked.filter(F.col("n").isNotNull() & (F.col("place") <= F.col("size") - F.ceil(F.col("size") * PERCENT / 100) + 1)).select("id", "shingle", "place")
    listed = staged(listed.join(classes, "id"), "prefixes")
    mixed_ones = listed.groupBy("shingle").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("shingle")
    listed = staged(listed.join(mixed_ones, "shingle", "left_semi").join(found.select("id", "n_shingles", "planes"), "id"), "mixed-prefixes")
    sides = [listed.select("shingle", *(F.col(c).alias(c + side) for c in ("id", "label", "apart", "place", "n_shingles", "planes"))) for side in ("_a", "_b")]
    ends = sides[0].filter("apart_a")
    needed = F.ceil((F.col("n_shingles_a") + F.col("n_shingles_b")) * PERCENT / (100 + PERCENT))
    left = 1 + F.least(F.col("n_shingles_a") - F.col("place_a"), F.col("n_shingles_b") - F.col("place_b"))
    met = ends.join(sides[1], (ends["shingle"] == sides[1]["shingle"]) & (F.col("label_a") != F.col("label_b")) & (left >= needed) & _may_link("_a", "_b"))
    return staged(met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct(), "pairs")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after ``links`` joined some of them."""
    if links.isEmpty():
        return labels
    one, two = labels.toDF("a", "x"), labels.toDF("b", "y")
    joined = staged(links.join(one, "a").join(two, "b").select(F.col("x").alias("a"), F.col("y").alias("b")).filter("a <> b").distinct(), "label-links")
    moved = components(joined.select(F.col("a").alias("id")).union(joined.select("b")).distinct(), joined).toDF("label", "new")
    return staged(labels.join(small(moved), "label", "left").select("id", F.coalesce("new", "label").alias("label")), "class-labels")


def _may_link(a: str, b: str) -> Column:
    """Whether sizes allow a link and the bit estimate is not far below the threshold."""
    one, two = F.col(f"n_shingles{a}"), F.col(f"n_shingles{b}")
    return (100 * F.least(one, two) >= PERCENT * F.greatest(one, two)) & (estimate(f"planes{a}", f"planes{b}") >= LEAST_ESTIMATE)


def _likely(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs that may be linked."""
    one = found.select(F.col("id").alias("a"), F.col("n_shingles").alias("n_shingles_a"), F.col("planes").alias("planes_a"))
    two = found.select(F.col("id").alias("b"), F.col("n_shingles").alias("n_shingles_b"), F.col("planes").alias("planes_b"))
    return staged(pairs.join(two, "b").join(one, "a").filter(_may_link("_a", "_b")).select("a", "b"), "pairs")


def _with_row_key(docs: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """``docs`` with ``_key``, which tells texts under one doc_id apart, and the same with each key once; None if no doc_id repeats.

    The key is the doc_id where that is unique, else a 64-bit hash of doc_id and text.
    """
    again = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_again"))
    again = staged(again, "repeated-ids")
    if again.isEmpty():
        return None
    marked = docs.join(small(again), F.col("doc_id") == F.col("_again"), "left")
    repeated = F.col("_again").isNotNull()
    key = F.when(repeated, F.xxhash64(F.col("doc_id").cast("long"), text_of())).otherwise(F.col("doc_id").cast("long"))
    keyed = marked.withColumn("_key", key)
    rows = keyed.select("_key", "text", repeated.alias("_many"))
    once = rows.filter("not _many").select("_key", "text").union(rows.filter("_many").select("_key", "text").dropDuplicates(["_key"]))
    return keyed.drop("_again"), once.withColumnRenamed("_key", "doc_id")


def near_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, set_a and set_b of every row.

    Texts are linked at a similarity of PERCENT or more; component_id is the smallest doc_id reachable. A null or
    empty text has no shingles and is linked with nothing; its component is itself. Repeated rows share a set and
    hence a component; a doc_id with several texts gives one row for each, in the component of that text. A row without
    doc_id takes the component of its set if a row with an id has that set, else null, and is kept only then. Other
    columns are ignored; an empty table gives no rows.
    """
    keys = _with_row_key(docs)
    return _by_unique_id(docs) if keys is None else _named_again(*keys).drop("key")


def _named_again(keyed: DataFrame, once: DataFrame) -> DataFrame:
    """The result for the rows of ``keyed`` from that for ``once``, whose ids are keys; components are named by the smallest doc_id."""
    found = staged(_by_unique_id(once).withColumnRenamed("doc_id", "key"), "keyed-components")
    named = keyed.filter("_key is not null").select("_key", F.col("doc_id").cast("long").alias("doc_id"))
    names = named.distinct().toDF("key", "name")
    least = found.join(names, "key").groupBy("component_id").agg(F.min("name").alias("least"))
    of_key = found.join(least, "component_id", "left").select("key", "n_shingles", F.col("least").alias("component_id"), "set_a", "set_b")
    rows = named.join(of_key.filter("key is not null"), F.col("_key") == F.col("key")).drop("_key")
    rows = rows.unionByName(of_key.filter("key is null").withColumn("doc_id", F.lit(None).cast("long")))
    return rows.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "set_a", "set_b", "key")


def _by_unique_id(docs: DataFrame) -> DataFrame:
    """``near_dedup`` of rows of which those with one doc_id have one text."""
    signs = staged(signed(docs), "signatures")
    found = classes(signs)
    labels = class_labels(found, docs.filter("doc_id is not null"))
    named = found.select("id", "set_a", "set_b").join(labels, "id").select("set_a", "set_b", "label")
    rows = signs.select("doc_id", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("label")).otherwise(F.col("doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "set_a", "set_b")


def keep_unique(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not near-duplicates of one with a smaller doc_id, columns as they were.

    Rows leave by doc_id, or by doc_id and text where a doc_id repeats; a row without one leaves if a row with an id has
    the same shingles.
    """
    keys = _with_row_key(docs)
    if keys is None:
        keyed = docs.withColumn("_key", F.col("doc_id").cast("long"))
        found = staged(_by_unique_id(docs).withColumn("key", F.col("doc_id")), "near-duplicates")
    else:
        keyed, found = keys[0], staged(_named_again(*keys), "near-duplicates")
    gone = small(found.filter("not kept and key is not null").select(F.col("key").alias("_id")).distinct())
    named = keyed.join(gone, F.col("_key") == F.col("_id"), "left_anti").drop("_key")
    unnamed = found.filter("doc_id is null and not kept").limit(1)
    if unnamed.isEmpty():
        return named
    taken = found.filter("doc_id is not null and n_shingles > 0").select("set_a", "set_b").distinct()
    bare = docs.filter("doc_id is null").withColumn("_row", F.monotonically_increasing_id())
    sets = signed(bare.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_row"), "set_a", "set_b").join(taken, ["set_a", "set_b"], "left_semi")
    return named.filter("doc_id is not null").unionByName(bare.join(sets, "_row", "left_anti").drop("_row"))
