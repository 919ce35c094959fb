"""SimHash fingerprints and trie self-joins against plain versions."""

import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from jobsignal.llm import simhash_dedup as sd
from jobsignal.llm.common import documents

COLUMNS = "doc_id long, text string, fp string, label long"
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    words = [w for w in text.translate(LETTERS).split(" ") if w]
    if not words:
        return 0
    own = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_labels(fps):
    """Smallest place reachable of each fingerprint, all pairs compared."""
    fps = np.array(fps, np.uint64)
    label = np.arange(len(fps))
    near = [np.flatnonzero(np.bitwise_count(fps ^ f) <= 4) for f in fps]
    while True:
        new = np.array([label[n].min() for n in near])
        if (new == label).all():
            return label
        label = new


def crowd(n, seed):
    """Random fingerprints, chains of near ones, and one large ball around a centre."""
    pick = random.Random(seed)
    fps = [pick.getrandbits(64) for _ in range(n // 3)]
    for f in fps[:n // 9]:
        for _ in range(3):
            f ^= sum(1 << b for b in pick.sample(range(64), pick.randrange(1, 6)))
            fps.append(f)
    centre = pick.getrandbits(64)
    fps += [centre ^ sum(1 << b for b in pick.sample(range(64), pick.randrange(0, 8))) for _ in range(n // 3)]
    return sorted(set(fps))


def test_fingerprints():
    texts = ["", "one", "One  two\tthree", "a b c d", "a b c d e f g " * 40, "É é ÀB x", "\x1c a b c d", "日本 語 x y z"]
    assert sd.fingerprints([t.encode() for t in texts]).tolist() == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("m", [5, 6, 7, 8])
def test_blocks(spark, m):
    pick = random.Random(m)
    kinds = sd.layouts(m)
    fps = [pick.getrandbits(64) for _ in range(50)]
    rows = spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long")
    for layout in kinds:
        keys = np.array([r[0] for r in rows.select(sd._key(layout)).collect()]).view(np.uint64)
        assert sd._fp(keys, layout).tolist() == fps
        back = rows.select(sd._key(layout).alias("key")).select(sd._fp_column(layout)).collect()
        assert [r[0] for r in back] == [r.fp for r in rows.collect()]
    # any four errors leave enough blocks untouched
    for _ in range(300):
        wrong = set(pick.sample(range(64), 4))
        assert any(all(not wrong & set(range(s, s + w)) for s, w in layout[:m - 4]) for layout in kinds)
    assert all(sum(w for _, w in layout[:m - 4]) >= sd.shared_bits(m) for layout in kinds)


def test_block_count_follows_the_corpus():
    assert [sd.block_count(n) for n in (0, 10**6, 10**8, 10**10, 10**12)] == [5, 5, 6, 7, 8]


def test_join_in_a_task(monkeypatch):
    monkeypatch.setattr(sd, "TASK_PAIRS", 500)
    for seed in range(4):
        keys = np.array(crowd(900, seed), np.uint64)
        label = sd.join_tries(keys, np.array([[0, len(keys), 0, len(keys), 0, 0]]))
        assert label.tolist() == plain_labels(keys).tolist()


def as_groups(pairs):
    groups = {}
    for f, g in pairs:
        groups.setdefault(g, set()).add(f)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("unit_leaves", [8192, 60])
def test_links(spark, tmp_path, unit_leaves):
    fps = crowd(1200, 9)
    path = str(tmp_path / "fps")
    spark.createDataFrame([(f - (f >> 63 << 64),) for f in fps], "fp long").write.parquet(path)
    links = [(r.a % 2**64, r.b % 2**64) for r in sd.links_of(spark.read.parquet(path), unit_leaves).collect()]
    place = {f: i for i, f in enumerate(fps)}
    label = sd.unite(np.arange(len(fps)), np.array([place[a] for a, _ in links]), np.array([place[b] for _, b in links]))
    assert as_groups(zip(fps, label.tolist())) == as_groups(zip(fps, plain_labels(fps).tolist()))
    assert len(links) < 40 * len(fps)


def plain(rows):
    fps = [plain_fingerprint(t or "") for _, t in rows]
    label = plain_labels(fps)
    least = {}
    for (i, _), g in zip(rows, label.tolist()):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return Counter((i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(rows, fps, label.tolist()))


def test_against_brute_force(spark):
    pick = random.Random(5)
    base = [" ".join(f"w{pick.randrange(3000)}" for _ in range(pick.randrange(3, 400))) for _ in range(120)]
    rows = list(enumerate(base))
    rows += [(500 + i, t + " end") for i, t in enumerate(base[:60])] + [(700 + i, t.upper()) for i, t in enumerate(base[60:90])]
    rows += [(900, None), (901, ""), (902, " \n"), (3, "other words under one id"), (3, base[5]), (3, base[5]), (None, base[7]), (None, "alone and without id"), (950, "x " * 200_000)]
    docs = spark.createDataFrame([(i, t, "own", 1) for i, t in rows], COLUMNS)
    got = sd.simhash_dedup(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_given_documents(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert Counter(map(tuple, sd.simhash_dedup(docs).collect())) == plain(rows)


def test_empty_table(spark):
    assert sd.simhash_dedup(spark.createDataFrame([], COLUMNS)).collect() == []
