"""The pipeline: order of stages, columns, and what each stage does to the rows it gets."""

import random

import tiktoken

import corpus_pipeline
from jobsignal.llm.byte_bpe import load_ranks
from jobsignal.llm.common import tokenizer_file
from jobsignal.llm.pretokens import PATTERN

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def texts():
    pick = random.Random(1)
    base = [" ".join("w%d" % pick.randrange(5000) for _ in range(80)) for _ in range(60)]
    near = [t.replace(t.split(" ")[40], "other") for t in base[:10]]
    return base + base[:5] + near + ["too short", None, "", "same again " * 40]


def test_stages(spark, tmp_path):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts())]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        path = str(tmp_path / name.replace(" ", "-"))
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = sorted(r.doc_id for r in docs.collect())
    assert kept["quality rules"] == list(range(75))
    assert kept["exact dedup"] == [*range(5, 75)]
    # near copies of 0-4 lost their originals to the exact stage, where the largest id stays
    assert kept["near dedup"] == [*range(5, 65)]
    assert set(kept["mixing"]) <= set(kept["near dedup"]) and max(map(kept["mixing"].count, kept["mixing"])) <= 2

    encoder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=load_ranks(tokenizer_file("byte_bpe_50k.tiktoken")), special_tokens={})
    found = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in found) == kept["mixing"]
    assert all(r.n_tokens == len(encoder.encode_ordinary(rows[r.doc_id][1])) for r in found)


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "sf")
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0
