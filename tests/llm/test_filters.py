"""Quality rules, quality model, exact and near dedup, mixing, licences and token counts on small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsignal.llm import exact_dedup, licenses, mixing, near_dedup, quality_model, quality_rules, token_counts
from jobsignal.llm.common import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, label string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y") for i, t, s in rows], SCHEMA)


def prose(pick, n):
    return " ".join("".join(pick.choices("abcdefghij", k=pick.randrange(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(11)
    texts = [prose(pick, pick.choice([3, 30, 120, 400])) for _ in range(60)]
    rows = []
    for i in range(300):
        words = pick.choice(texts).split(" ")
        for _ in range(pick.choice([0, 0, 1, 3, 8, 30])):
            words[pick.randrange(len(words))] = "edit%d" % pick.randrange(10**6)
        rows.append((i, pick.choice(["", "\n", " \t "]).join([" ".join(words), ""]), f"s{pick.randrange(4)}"))
    rows += [(1000, None, None), (1001, "", "s1"), (1002, " \n\t", None), (1003, None, "s2"), (None, rows[0][1], "s0"), (None, "only here", None)]
    return rows + [rows[5], (1004, rows[5][1].upper(), "s0"), (1005, "x " * 3000 + "É\x1c\x85 y", "s3")]


def brute_rules(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if grams[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_rules(spark, corpus):
    rows = corpus + [(2000 + i, "bad", "worst") for i in range(40)] + [(2100, prose(random.Random(1), 50), "worst")]
    rows += [(2200, "a b # c|d\na b # c|d\n" + "one two three four five six seven eight nine " * 3, "s1")]
    found = quality_rules.quality_rules(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    want = Counter((i, *brute_rules(t)) for i, t, _ in rows)
    assert Counter((r.doc_id, *(r[m] for m in quality_rules.MEASURES)) for r in found) == want
    by_id = {r.doc_id: r for r in found}
    assert not by_id[2100].base_failed and not by_id[2100].kept  # its host fails
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in found)
    assert sum(r.kept for r in found) > 50
    kept = quality_rules.keep_good(frame(spark, rows))
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if r.kept)
    assert quality_rules.quality_rules(frame(spark, rows).limit(0)).count() == 0


def test_exact(spark, corpus):
    found = exact_dedup.split_dedup(frame(spark, corpus)).collect()
    groups = defaultdict(list)
    for i, t, _ in corpus:
        groups[t or ""].append(i)
    tops = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter((i, tops[t or ""], len(groups[t or ""]), i == tops[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in corpus)
    assert Counter(map(tuple, found)) == want
    kept = exact_dedup.keep_unique(frame(spark, corpus))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in found if r.kept)
    assert exact_dedup.split_dedup(frame(spark, corpus).limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 100, 20_000])
def test_fuse_filter(n):
    keys = np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64)
    built = exact_dedup.build_filter(keys)
    assert exact_dedup.may_hold(keys, *built).all()
    others = np.random.default_rng(1).integers(1 << 63, (1 << 64) - 1, 20_000, np.uint64)
    assert exact_dedup.may_hold(others, *built).mean() < 0.01
    assert n < 1000 or len(built[3]) < 1.3 * n


def brute_components(rows):
    sets = []
    for _, text, _ in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(rows)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if a and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                label[find(i)] = find(j)
    best = {}
    for i, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            best[find(i)] = min(best.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), best.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _, _) in enumerate(rows)]


def test_near(spark, corpus):
    found = near_dedup.near_dedup(frame(spark, corpus)).collect()
    want = brute_components(corpus)
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    assert 5 < sum(not r.kept for r in found) < 290
    kept = near_dedup.keep_unique(frame(spark, corpus))
    assert Counter(r.doc_id for r in kept.collect()) == Counter(i for i, _, c in want if i == c)
    assert near_dedup.near_dedup(frame(spark, corpus).limit(0)).count() == 0


def test_near_group_with_a_shared_passage(spark):
    pick = random.Random(2)
    base, passage = prose(pick, 150).split(" "), prose(pick, 60)
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(pick.randrange(12)):
            words[pick.randrange(150)] = "w%d" % pick.randrange(10**6)
        rows.append((i, " ".join(words), "a"))
    rows += [(1000 + i, passage + " " + prose(pick, 60), "b") for i in range(250)]
    pick.shuffle(rows)
    found = near_dedup.near_dedup(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == Counter(brute_components(rows))


def test_estimate_is_close(spark):
    pick = random.Random(4)
    base = prose(pick, 600).split(" ")
    for share in (0.0, 0.1, 0.3):
        other = [w if pick.random() > share / 5 else "z%d" % pick.randrange(10**6) for w in base]
        texts = [" ".join(base), " ".join(other)]
        a, b = map(near_dedup.shingle_set, texts)
        rows = near_dedup.signed(frame(spark, list(zip((1, 2), texts, "ab")))).select("doc_id", "planes")
        pair = rows.filter("doc_id = 1").select(F.col("planes").alias("p")).crossJoin(rows.filter("doc_id = 2").select(F.col("planes").alias("q")))
        assert abs(pair.select(near_dedup.estimate("p", "q")).first()[0] - len(a & b) / len(a | b)) < 0.12


def brute_targets(sizes):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, target = 1.5 * sum(sizes.values()), {}
    while True:
        opened = [s for s in order if s not in target]
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[o] for o in opened) for s in opened}
        over = [s for s in opened if share[s] > 2 * sizes[s]]
        if not over:
            return target | share
        target |= {s: 2.0 * sizes[s] for s in over}


def test_mixing(spark, corpus):
    pick = random.Random(8)
    rows = corpus + [(3000 + i, prose(pick, pick.randrange(1, 60)), pick.choice(["s0", "s1", "é", "𝒵", None])) for i in range(800)]
    df = frame(spark, rows)
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    target = brute_targets(dict(sizes))
    source = {(r.doc_id, r.size): None for r in found}
    by_target = defaultdict(int)
    for r in found:
        assert r.taken <= 2 * r.size and r.taken % max(r.size, 1) == 0
        by_target[round(r.target, 3)] += r.taken
    assert len(source) > 900
    for s, wanted in target.items():
        assert round(wanted, 3) in by_target, s
        assert abs(by_target[round(wanted, 3)] - wanted * sum(round(t, 3) == round(wanted, 3) for t in target.values())) <= 0.02 * wanted + 20
    assert Counter(map(tuple, mixing.mix(df.repartition(5)).collect())) == Counter(map(tuple, found))
    copies = Counter(r.doc_id for r in mixing.mixed(df).collect())
    assert all(copies[r.doc_id] == r.taken // r.size for r in found if r.size and r.doc_id is not None and r.doc_id >= 3000)
    assert mixing.mix(df.limit(0)).count() == 0


def test_quality_model(spark):
    pick = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        good = pick.random() < 0.7
        text = prose(pick, pick.randrange(20, 80))
        rows.append((i, text if good else re.sub(" ", pick.choice(["### ", "*** ", " | "]), text), "s"))
        labels.append((i, int(good), 0))
    rows += [(9000, None, None), (9001, "", "s"), (None, "x", "s"), rows[3]]
    labelled = spark.createDataFrame(labels + [(7777, 1, 0), (5, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    found = quality_model.classify(frame(spark, rows), labelled).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 80 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.95
    unlabelled = quality_model.classify(frame(spark, rows[:3]), labelled.limit(0)).collect()
    assert [r.score for r in unlabelled] == [0.5] * 3
    assert quality_model.classify(frame(spark, rows).limit(0), labelled).count() == 0


def test_flat_trees_match_a_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, len(quality_model.STATISTICS)))
    y = (x[:, 0] + x[:, 3] ** 2 > 1).astype(float)
    trees = quality_model.fit(x, y)
    margins = []
    for row in x[:50]:
        total = trees.start
        for features, values, leaves in zip(trees.features, trees.values, trees.leaves):
            node = 0
            while node < len(features):
                node = 2 * node + 1 + int(row[features[node]] > values[node])
            total += leaves[node - len(features)]
        margins.append(total)
    assert np.allclose(margins, trees.margins(x[:50])) and ((trees.scores(x) > 0.5) == y).mean() > 0.97


def test_near_dedup_of_repeated_ids(spark):
    """One row per input row, each in the component of its own text, however often its doc_id occurs."""
    pick = random.Random(21)
    one, two, three = (prose(pick, n) for n in (60, 50, 70))
    rows = [(1, one, "s"), (1, two, "s"), (2, one + " end", "s"), (3, two + " end", "s"), (1, one, "s"), (7, three, "s"), (7, three, "s"), (7, "", "s"),
            (None, one, "s"), (9, three + " end", "s"), (None, "nothing like it at all here", "s"), (5, "", "s")]
    found = near_dedup.near_dedup(frame(spark, rows)).collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found)
    size = lambda t: len(near_dedup.shingle_set(t))
    assert got == Counter({(1, size(one), 1, True): 2, (1, size(two), 1, True): 1, (2, size(one) + 1, 1, False): 1, (3, size(two) + 1, 1, False): 1,
                           (7, size(three), 7, True): 2, (7, 0, 7, True): 1, (None, size(one), 1, False): 1, (9, size(three) + 1, 7, False): 1,
                           (None, 2, None, True): 1, (5, 0, 5, True): 1})
    kept = near_dedup.keep_unique(frame(spark, rows))
    assert kept.columns == SCHEMA.replace(",", "").split()[::2]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        [(1, one), (1, one), (1, two), (7, three), (7, three), (7, ""), (5, ""), (None, "nothing like it at all here")])


def test_model_takes_a_doc_id_once(spark):
    pick = random.Random(22)
    ids = [i for i in range(60) if not quality_model_held_out(i)]
    docs = [(i, prose(pick, 30), "s") for i in ids] + [(ids[0], prose(pick, 30), "s") for _ in range(500)]
    labels = spark.createDataFrame([(i, i % 2) for i in ids for _ in range(3)], "doc_id long, quality int")
    seen = []
    fit = quality_model.fit
    try:
        quality_model.fit = lambda x, y: (seen.append(x.shape), fit(x, y))[1]
        quality_model.train(frame(spark, docs), labels)
    finally:
        quality_model.fit = fit
    assert seen == [(len(ids), len(quality_model.STATISTICS))]


def quality_model_held_out(i):
    import zlib
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_licences(spark):
    pick = random.Random(9)
    lines = {"MIT": "Released under the MIT License.", "GPL": "This work is licensed under the GNU General Public License, version 3.",
             "LGPL": "licensed under the GNU Lesser General Public License, version 2.1", "CC-BY": "Licensed under CC BY 4.0.",
             "CC-BY-NC": "Licensed under CC BY-NC 4.0.", "BSD": "SPDX-License-Identifier: BSD-3-Clause", "": "My licence to drive was found under a general store."}
    kinds = list(lines)
    rows = [(i, prose(pick, 20) + "\n\n" + lines[kinds[i % len(kinds)]] + "\r\n" + prose(pick, 9), "s") for i in range(140)]
    rows += [(900, None, None), (901, "", "s"), (902, "\n \n", "s"), (None, lines["MIT"], "s"), (903, lines["MIT"] + "\n" + lines["GPL"], "s"), rows[0]]
    found = licenses.scan(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None and r.doc_id < 900:
            kind = kinds[r.doc_id % len(kinds)]
            assert (r.families, r.n_paragraphs) == (kind, 3) and r.licences == (f"2:{kind}" if kind else ""), r
    rest = {r.doc_id: r for r in found}
    assert [rest[k].n_paragraphs for k in (900, 901, 902)] == [0, 0, 0]
    assert rest[903].licences == "1:MIT,2:GPL" and rest[None].families == "MIT"
    assert licenses.scan(frame(spark, rows).limit(0)).count() == 0


def test_licences_of_a_hot_source(spark):
    pick = random.Random(10)
    mit, bsd = licenses.NOTICES["MIT"][2], licenses.NOTICES["BSD"][2]
    weak = {"GPL": "Licensed under the GNU GPL version 2 or later.", "CC0": "Dedicated to the public domain under CC0 1.0 Universal."}
    want = {i: {0: "MIT", 1: "BSD"}.get(i % 3, ["GPL", "CC0", ""][i // 3 % 3]) for i in range(450)}
    lines = {"MIT": mit, "BSD": bsd, "": "plain words only", **weak}
    found = licenses.scan(frame(spark, [(i, prose(pick, 20) + "\n" + lines[w] + "\n" + prose(pick, 9), "s") for i, w in want.items()])).collect()
    assert {r.doc_id: r.families for r in found} == want


def test_licence_counts_and_threshold_cover_the_corpus(spark):
    """Words and false alarms outside the documents of the sample count, too."""
    pick = random.Random(12)
    rows = [(i, "\n".join([prose(pick, 8), "gnu " + prose(pick, 8), "The affero word, and " + prose(pick, 3)]), "s") for i in range(200)]
    rows += [(1000 + i, licenses.NOTICES["GPL"][2] + "\nwe call the redistribute word " + prose(pick, 3), "s") for i in range(3)]
    model = licenses.train(frame(spark, rows), sample_documents=1)
    assert not {"gnu", "affero"} & set(model.rare) and {"gpl", "redistribute"} <= set(model.rare)
    known = sorted({g for texts in licenses.NOTICES.values() for t in texts for n in (1, 2, 3) for g in brute_grams(t, n)})
    found = licenses.unknown_paragraphs(frame(spark, rows), known, 1).collect()
    notices = [set(brute_grams(t, 2)) for texts in licenses.NOTICES.values() for t in texts]

    def a_notice(line):
        mine = set(brute_grams(line, 2))
        return any(mine & notice and len(mine & notice) >= 0.6 * min(len(mine), len(notice)) for notice in notices)

    lines = [x for _, t, _ in rows for x in t.split("\n")]
    assert sum(map(a_notice, lines)) == 3
    want = Counter((tuple(sorted({g for n in (1, 2, 3) for g in brute_grams(x, n)} & set(known))), bool(re.search("(?i)licen[sc]|copyright", x))) for x in lines if not a_notice(x))
    assert Counter((tuple(sorted(r._grams)), r.named) for r in found) == want
    held = [r.p for r in model.scored_grams(licenses.unknown_paragraphs(frame(spark, rows), known, 1).filter("held")).collect()]
    assert len(held) > 60 and sum(p > model.least for p in held) <= licenses.FALSE_ALARMS * len(held)


def test_notice_grams_against_brute_force(spark):
    pick = random.Random(3)
    parts = [w for texts in licenses.NOTICES.values() for t in texts for w in t.split()] + ["der", "Test", "x-y", "été"]
    lines = [" ".join(pick.choice(parts) for _ in range(pick.randrange(0, 25))) for _ in range(300)]
    for texts in licenses.NOTICES.values():
        for text in texts:
            own = text.split()
            lines += [" ".join(own[pick.randrange(4):][:pick.randrange(2, 20)] + [pick.choice(parts) for _ in range(pick.randrange(6))]) for _ in range(6)]
    known = sorted({g for texts in licenses.NOTICES.values() for t in texts for n in (1, 2, 3) for g in brute_grams(t, n)})
    rows = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("tokens", licenses.words(F.col("line")))
    notices = [set(brute_grams(t, 2)) for texts in licenses.NOTICES.values() for t in texts]
    families = {name: [set(brute_grams(t, 2)) for t in texts] for name, texts in licenses.NOTICES.items()}
    found = licenses._notice_grams(rows, known).withColumn("share", licenses._confirmed(F.col("tokens"), F.lit("GPL"))).collect()
    seen = 0
    for r in found:
        words = [w for w in re.split(r"[^a-zà-ÿ0-9]+", r.line.lower()) if w]
        assert r.tokens == words
        every = [[" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] for n in (1, 2, 3)]
        mine = set(every[1])
        assert set(r._grams) == set(sum(every, [])) & set(known) and len(r._grams) == len(set(r._grams)), r.line
        want = any(mine & n and len(mine & n) >= 0.6 * min(len(mine), len(n)) for n in notices)
        assert r._notice == want, r.line
        assert abs(r.share - max((len(mine & n) / min(len(mine), len(n)) if mine else 0.0) for n in families["GPL"])) < 1e-9
        seen += want
    assert 50 < seen < len(lines) - 50


def brute_grams(text, n):
    tokens = re.findall("[a-z0-9]+", text.lower())
    return [" ".join(tokens[i:i + n]) for i in range(len(tokens) - n + 1)]


def test_token_counts(spark, corpus):
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    scores, longest = token_counts.piece_scores(path)
    found = token_counts.token_counts(frame(spark, corpus), path).collect()
    assert len(found) == len(corpus)

    def brute(raw):
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(raw)
        for end in range(1, len(raw) + 1):
            options = [(best[s][0] + scores[raw[s:end]], -best[s][1] - 1) for s in range(max(0, end - longest), end) if raw[s:end] in scores]
            score, tokens = max(options)
            best[end] = (score, -tokens)
        return best[-1]

    from jobsignal.llm.pretokens import pretokens
    want = Counter()
    for doc_id, text, _ in corpus[:40] + corpus[-9:]:
        joined, starts, ends, _ = pretokens([text or ""])
        parts = [brute(joined[a:b].encode()) for a, b in zip(starts, ends)]
        want[(doc_id, len(parts), sum(p[1] for p in parts), round(sum(p[0] for p in parts), 4))] += 1
    got = Counter((r.doc_id, r.n_pretokens, r.n_tokens, round(r.log_score, 4)) for r in found)
    assert not want - got
    trie = token_counts.Trie(path)
    raw = "langeswort " * 30
    assert trie.forward(raw.encode()) == trie.insert(raw.encode())
