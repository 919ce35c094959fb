"""Registered queries of the training-data operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsignal.llm import byte_bpe, licenses
from jobsignal.llm.common import documents, tokenizer_file
from jobsignal.llm.exact_dedup import split_dedup
from jobsignal.llm.mixing import mix
from jobsignal.llm.near_dedup import near_dedup
from jobsignal.llm.periodic_runs import digests, periodic_runs, repeated_tail
from jobsignal.llm.quality_model import classify
from jobsignal.llm.quality_rules import quality_rules
from jobsignal.llm.secrets import scan
from jobsignal.llm.simhash_dedup import simhash_dedup
from jobsignal.llm.token_counts import token_counts
from jobsignal.llm.warc import archive_round_trip
from jobsignal.llm.whitening import whiten
from jobsignal.plans.registry import registry

QUERIES, query = registry()


@query("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"))


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.tiktoken"))


@query("op3_secrets")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))


@query("op4_quality_model")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


@query("op5_quality_rules", r"""
    with split as (select doc_id, source, coalesce(text, '') as t,
            list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
    base as (select doc_id, source, w, len(w) as n_words,
            coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols,
            list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from split),
    grams as (select doc_id, unnest(range(n_words - 7)) as i, w from base where n_words >= 8),
    twice as (select doc_id, i, count(*) over (partition by doc_id, w[i + 1:i + 8]) as n from grams),
    covered as (select doc_id, count(distinct p) as n_repeat_words
        from (select doc_id, unnest(range(i, i + 8)) as p from twice where n > 1) group by doc_id),
    rules as (select doc_id, source, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
            coalesce(n_repeat_words, 0) as n_repeat_words from base left join covered using (doc_id)),
    judged as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from rules),
    hosts as (select source, count(*) as n, sum(base_failed::int) as bad from judged group by source),
    moments as (select avg(bad / n) as m, var_pop(bad / n) as v, avg(n) as size from hosts),
    prior as (select m, case when v <= 0 then size else least(greatest(m * (1 - m) / v - 1, 1), size) end as s from moments),
    verdicts as (select source, (bad + m * s) / (n + s) > 0.5 as rejected from hosts, prior)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        not base_failed and not rejected as kept
    from judged join verdicts on judged.source is not distinct from verdicts.source""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


@query("op6_near_dedup", r"""
    with recursive split as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
    sets as (select distinct doc_id, array_to_string(s, ' ') as s from (select doc_id, unnest(case
            when len(w) >= 5 then list_transform(range(len(w) - 4), lambda i: w[i + 1:i + 5]) when len(w) > 0 then [w] else [] end) as s from split)),
    sizes as (select doc_id, count(*) as n from sets group by doc_id),
    common as (select a.doc_id as x, b.doc_id as y, count(*) as c from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id group by all),
    links as (select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * c >= 75 * (a.n + b.n - c)),
    reach as (select doc_id, doc_id as r from documents union select doc_id, y from reach join links on r = x)
    select doc_id, coalesce(any_value(n), 0) as n_shingles, min(r) as component_id, doc_id = min(r) as kept
    from reach left join sizes using (doc_id) group by doc_id""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(documents(spark, sf_dir)).drop("set_a", "set_b")


@query("op7_exact_dedup", """
    select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256
    from (select doc_id, coalesce(text, '') as t, max(doc_id) over (partition by coalesce(text, '')) as keep_id,
                 count(*) over (partition by coalesce(text, '')) as group_size from documents)""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_dedup(documents(spark, sf_dir))


@query("op8_warc", """
    select page_id, strlen(h) as payload_bytes, sha256(h) as payload_digest,
        case when again then 'revisit' else 'response' end as record_type, case when again then m end as refers_to
    from (select *, strlen(h) >= 100 and page_id <> m as again
          from (select page_id, coalesce(html, '') as h, min(page_id) over (partition by coalesce(html, '')) as m from pages))""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op9_mixing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


@query("op10_licenses")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


@query("op11_simhash_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(documents(spark, sf_dir))


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(periodic_runs(documents(spark, sf_dir), repeated_tail))
