"""Licence scan: a paragraph classifier over word n-grams, confirmed against the licence notices.

Training paragraphs are crops of known notices, some sentences that only sound like licences, and a bounded sample of
the corpus's own paragraphs as the unknown class, but those that hold most of a notice. N-grams of the notices that are
frequent in the whole corpus are no features, so every feature contains a rare word; paragraphs without such a word have
no feature and are unknown without being scored. A sparse (L1) multinomial logistic regression scores the others. The
probability a family needs is set from all unknown paragraphs of the corpus that were held out, those that name a licence
or a copyright without holding a notice included: they are the hard ones. A prediction counts when the paragraph also
shares enough two-word shingles with a notice of the predicted family.

DataFrame functions and pyspark.ml only; both run in the JVM.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsignal.llm.common import hashed_sample, small, staged, text_of

# Notices of licence families.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Licensed under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "BSD": [
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC0": [
        "This is free and unencumbered software released into the public domain.",
        "Dedicated to the public domain under CC0 1.0 Universal.",
    ],
}
# Sentences of the unknown class.
UNKNOWN_NOTICES = [
    "All rights reserved.", "Copyright 2020 by the authors.", "See the license file for details.", "The terms of the license are unclear.",
    "He lost his driving licence in the city.", "A license plate was found near the public library.", "The software was released last year.",
    "Version 2.0 of the report is under review.", "The general assembly is open to the public.", "A creative and commercial work of art.",
    "The foundation published the document.", "This file is the source of the problem.", "No permission is required to use the library.",
]
UNKNOWN = "unknown"
FAMILIES = [*NOTICES, UNKNOWN]
# Documents whose paragraphs make the unknown class: those with the smallest hashes of their ids.
SAMPLE_DOCUMENTS = 500
# N-grams and words in more than this share of the corpus's unknown paragraphs are no features.
MOST_COMMON = 0.005
# False alarms allowed among held-out unknown paragraphs, and the share of shingles that confirms a family.
FALSE_ALARMS, CONFIRMED = 0.002, 0.6


def words(text: Column) -> Column:
    """Lower-case words: runs of letters or digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def grams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` words, joined by blanks; none if there are fewer."""
    runs = tokens
    for k in range(1, n):
        runs = F.zip_with(runs, F.slice(tokens, k + 1, F.greatest(F.size(tokens), F.lit(0))), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.slice(runs, 1, F.greatest(F.size(tokens) - (n - 1), F.lit(0)))


def features_of(tokens: Column) -> Column:
    return F.array_distinct(F.concat(*(grams(tokens, n) for n in (1, 2, 3))))


def _pairs_of(text: str) -> list[str]:
    """Distinct two-word shingles of a notice, as ``grams`` gives them."""
    own = re.findall(r"[^\W_]+", text.lower())
    return sorted({f"{a} {b}" for a, b in zip(own, own[1:])})


def _rows(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    values = F.array(*(F.struct(F.lit(a).alias("family"), F.lit(b).alias("text")) for a, b in pairs))
    return spark.range(1).select(F.explode(values).alias("v")).select("v.*")


def _crops(notices: DataFrame) -> DataFrame:
    """Runs of all, four fifths and three fifths of the words of each notice, of at least four words or all."""
    sized = notices.select("family", words(F.col("text")).alias("all")).withColumn("n", F.size("all"))
    lengths = F.array_distinct(F.transform(F.array(F.lit(1.0), F.lit(0.8), F.lit(0.6)), lambda x: F.least(F.col("n"), F.greatest(F.lit(4), F.ceil(x * F.col("n")).cast("int")))))
    starts = sized.withColumn("length", F.explode(lengths)).withColumn("start", F.explode(F.sequence(F.lit(1), F.col("n") - F.col("length") + 1)))
    return starts.select("family", F.slice("all", F.col("start"), F.col("length")).alias("tokens"))


def _paragraphs() -> Column:
    return F.filter(F.split("_text", "\n"), lambda line: F.trim(line) != "")


class LicenceModel:
    """Vocabulary, its rare words, the regression and the probability a family needs."""

    def __init__(self, vocabulary: list[str], rare: list[str], vectors: CountVectorizerModel | None, regression: LogisticRegressionModel | None, least: float) -> None:
        self.vocabulary, self.rare, self.vectors, self.regression, self.least = vocabulary, rare, vectors, regression, least

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with ``tokens``) and ``family`` and ``p``: the likeliest class but unknown, and its probability."""
        return self.scored_grams(rows.withColumn("_grams", features_of(F.col("tokens"))))

    def scored_grams(self, rows: DataFrame) -> DataFrame:
        """As ``scored``, of rows with ``_grams``; those outside the vocabulary don't count."""
        known = self.regression.transform(self.vectors.transform(rows))
        chances = F.slice(vector_to_array("_probability"), 1, len(NOTICES))
        named = known.withColumn("p", F.array_max(chances)).withColumn("family", F.element_at(F.array(*map(F.lit, NOTICES)), F.array_position(chances, F.col("p")).cast("int")))
        return named.drop("_grams", "_features", "_raw", "_probability", "_class")


def _listed(values: list[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def _notice_grams(rows: DataFrame, known: list[str]) -> DataFrame:
    """``rows`` (with ``tokens``) and ``_grams``, ``features_of`` the tokens as far as they are in ``known``, and
    ``_notice``, whether the paragraph would be confirmed for any family.

    Each step looks only at paragraphs that the one before left possible: pairs of words where two words of notices
    stand, triples where two of their pairs stand, notices where pairs enough stand for the shortest one.
    """
    of_size = [[g for g in known if g.count(" ") == n] for n in range(3)]
    none = F.array().cast("array<string>")
    notices = [_pairs_of(text) for texts in NOTICES.values() for text in texts]
    fewest = min(map(len, notices))
    found = rows.withColumn("_ones", F.array_intersect("tokens", _listed(of_size[0])))
    found = found.withColumn("_pairs", F.when(F.size("_ones") >= 2, grams(F.col("tokens"), 2)).otherwise(none))
    found = found.withColumn("_mine", F.size(F.array_distinct("_pairs"))).withColumn("_pairs", F.array_intersect("_pairs", _listed(of_size[1])))
    triples = F.when(F.size("_pairs") >= 2, F.array_intersect(grams(F.col("tokens"), 3), _listed(of_size[2]))).otherwise(none)
    near = F.exists(F.array(*map(_listed, notices)), lambda notice: F.size(F.array_intersect("_pairs", notice)) >= CONFIRMED * F.least(F.col("_mine"), F.size(notice)))
    enough = (F.size("_pairs") > 0) & (F.size("_pairs") >= CONFIRMED * F.least(F.col("_mine"), F.lit(fewest)))
    return found.withColumn("_grams", F.concat("_ones", "_pairs", triples)).withColumn("_notice", F.when(enough, near).otherwise(False)).drop("_ones", "_pairs", "_mine")


def unknown_paragraphs(docs: DataFrame, known: list[str], sample_documents: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """All paragraphs of the unknown class: their n-grams in ``known``, whether they name a licence or a copyright,
    whether they are held out, and whether sampled.

    Paragraphs that hold most of a notice are left out: however often a notice occurs, it is no example of the unknown
    class. Every fifth of the others (by hash) is held out.
    """
    chosen = hashed_sample(docs.filter("doc_id is not null").select("doc_id"), "doc_id", sample_documents).distinct()
    marked = docs.select("doc_id", text_of().alias("_text")).join(small(chosen.withColumn("sampled", F.lit(True))), "doc_id", "left")
    lines = marked.select(F.coalesce("sampled", F.lit(False)).alias("sampled"), F.explode(_paragraphs()).alias("text"))
    rows = lines.select("sampled", (F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("held"), F.col("text").rlike("(?i)licen[sc]|copyright").alias("named"),
                        words(F.col("text")).alias("tokens"))
    # Written before it is filtered: a filter would be pushed down to the words and repeat all steps there.
    found = _notice_grams(rows, known).select("sampled", "held", "named", "_grams", "_notice")
    return staged(found, "unknown-paragraphs").filter("not _notice").drop("_notice")


def train(docs: DataFrame, sample_documents: int = SAMPLE_DOCUMENTS) -> LicenceModel:
    """The classifier. Its n-gram counts and its threshold come from all unknown paragraphs of the corpus.

    Only the regression is fitted on a sample: the unknown paragraphs, but the held-out ones, of at most
    ``sample_documents`` documents.
    """
    spark = docs.sparkSession
    notices = _rows(spark, [(family, text) for family, texts in NOTICES.items() for text in texts])
    crops = staged(_crops(notices), "notice-crops")
    known = sorted(r.gram for r in crops.select(F.explode(features_of(F.col("tokens"))).alias("gram")).distinct().collect())  # n-grams of the notices only
    plain = unknown_paragraphs(docs, known, sample_documents)
    ordinary = plain.filter("not named")
    total = max(ordinary.count(), 1)
    counts = ordinary.select(F.explode("_grams").alias("gram")).groupBy("gram").count()
    common = {r.gram for r in counts.filter(F.col("count") > MOST_COMMON * total).collect()}
    vocabulary = [g for g in known if g not in common]
    rare = [g for g in vocabulary if " " not in g]
    vocabulary = [g for g in vocabulary if set(g.split()) & set(rare)]
    doubtful = _rows(spark, [(UNKNOWN, text) for text in UNKNOWN_NOTICES]).select("family", words(F.col("text")).alias("tokens"))
    unknown = ordinary.filter("sampled and not held").select(F.lit(UNKNOWN).alias("family"), "_grams")
    rows = crops.unionByName(doubtful).select("family", features_of(F.col("tokens")).alias("_grams")).unionByName(unknown).select(
        "family", (F.array_position(F.array(*map(F.lit, FAMILIES)), F.col("family")) - 1).cast("double").alias("label"), "_grams")
    rows = rows.withColumn("weight", F.when(F.col("family") == UNKNOWN, 0.2).otherwise(1.0))
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_grams", outputCol="_features")
    vectors.setBinary(True)
    training = vectors.transform(staged(rows, "licence-training"))
    regression = LogisticRegression(featuresCol="_features", labelCol="label", weightCol="weight", predictionCol="_class", probabilityCol="_probability",
                                    rawPredictionCol="_raw", family="multinomial", regParam=2e-4, elasticNetParam=1.0, maxIter=60, standardization=False)
    model = LicenceModel(vocabulary, rare, vectors, regression.fit(training), 0.5)
    held = model.scored_grams(plain.filter("held").select("_grams"))
    worst = held.agg(F.percentile_approx("p", 1 - FALSE_ALARMS, 100_000)).first()[0]
    model.least = max(0.5, worst or 0.0)
    return model


def _confirmed(tokens: Column, family: Column) -> Column:
    """Share of the paragraph's two-word shingles in the family's notices, or of the best notice in the paragraph."""
    best = F.lit(0.0)
    for name, texts in NOTICES.items():
        shares = []
        mine = F.array_distinct(grams(tokens, 2))
        for text in texts:
            notice = _pairs_of(text)
            common = F.size(F.array_intersect(mine, _listed(notice)))
            shares.append(common / F.greatest(F.least(F.size(mine), F.lit(len(notice))), F.lit(1)))
        best = F.when(family == name, F.greatest(*shares)).otherwise(best)
    return F.coalesce(best, F.lit(0.0))


def scan(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """doc_id, n_paragraphs, n_candidates, families and licences of every row.

    Paragraphs are the lines with something else than blanks. ``licences`` lists place:family of the confirmed
    paragraphs (places count from 1 among the paragraphs), ``families`` the distinct families, both comma-joined and
    sorted; n_candidates counts the paragraphs with a feature. A null or empty text has no paragraphs. Repeated rows are
    scanned alike; other columns are ignored; an empty table gives no rows.
    """
    model = model or train(docs)
    gate = F.array(*map(F.lit, model.rare))
    lines = docs.select("doc_id", text_of().alias("_text")).select("doc_id", _paragraphs().alias("lines"))
    tokens = F.transform("lines", lambda line, i: F.struct((i + 1).alias("place"), words(line).alias("tokens")))
    rows = lines.select("doc_id", F.size("lines").cast("long").alias("n_paragraphs"), F.filter(tokens, lambda t: F.arrays_overlap(t["tokens"], gate)).alias("found"))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "licence-candidates")
    scored = model.scored(rows.select("row", F.explode("found").alias("f")).select("row", "f.place", "f.tokens"))
    kept = scored.filter(F.col("p") >= model.least).filter(_confirmed(F.col("tokens"), F.col("family")) >= CONFIRMED)
    hits = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "family"))).alias("hits"))
    joined = rows.join(hits, "row", "left").withColumn("hits", F.coalesce("hits", F.array().cast("array<struct<place:int,family:string>>")))
    return joined.select(
        "doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_candidates"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["family"]))), ",").alias("families"),
        F.array_join(F.transform("hits", lambda h: F.concat_ws(":", h["place"], h["family"])), ",").alias("licences"))
