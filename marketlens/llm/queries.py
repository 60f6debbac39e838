"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_model, kneser_ney, line_rules, order_minhash, packing, quality_trees, rlz_dedup, run_grammar, spelling, suffix_dedup, token_store, url_filter, version_sketch

URL_RULES = [
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]
#: The URL query lists the canonical URLs that at least so many pages have.
LISTED_FROM = 2


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(_documents(spark, sf_dir))


def op2_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz_dedup.word_removal_report(_documents(spark, sf_dir))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.token_report(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(_documents(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


def op6_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_trees.judged(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.judged(_documents(spark, sf_dir), with_text=True)


def op8_version_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return version_sketch.fingerprint_report(_documents(spark, sf_dir))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_model.encoded(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    url = F.col("url")
    names = pages.select(url_filter.canonical(url_filter.url_host(url), url_filter.url_path(url)).alias("canonical"))
    listed = names.groupBy("canonical").count().where(F.col("count") >= LISTED_FROM).select("canonical")
    return url_filter.judged(pages, URL_RULES, listed)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text; with h the crc32 of the id as text and g = h div 10, in
    texts of n words with h % 10 = 0 each word i from a = g % n on becomes word
    a + (i - a) % p of the text, where p = 1 + (n - a) div (3 + g % 8)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.when(h % 10 == 0, F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    cut = docs.select("doc_id", text.alias("text"), F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    placed = cut.withColumn("a", F.col("g") % F.nullif(n, F.lit(0)))
    placed = placed.withColumn("p", F.expr("1 + (size(words) - a) div (3 + g % 8)"))
    a, p = F.col("a"), F.col("p")
    repeated = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get(F.col("words"), (a + (i - a) % p).cast("int"))))
    return placed.select("doc_id", F.when(n > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


def op11_recompression_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_grammar.run_report(with_planted_runs(_documents(spark, sf_dir)))


def op12_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.score_report(_documents(spark, sf_dir))


def with_typos(doc_id: int, runs: list[str]) -> list[str]:
    """Each run without its code point h % length where 97 divides h, the crc32
    of ``<doc_id>:<run>``."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    out = []
    for run in runs:
        h = zlib.crc32(run.encode(), seed)
        at = h % len(run)
        out.append(run if h % 97 else run[:at] + run[at + 1 :])
    return out


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_report(_documents(spark, sf_dir), with_typos)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_suffix_array, op2_lempel_ziv, op3_token_store, op4_order_minhash, op5_packing,
        op6_quality_trees, op7_line_rules, op8_version_sketch, op9_byte_bpe, op10_url_filter,
        op11_recompression_runs, op12_kneser_ney, op13_spelling_variants,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where SQL can express the query on whole tables."""
    return {"op10_url_filter": _url_sql()}


def _url_sql() -> str:
    host = "translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = "regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2)"
    values = ", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in URL_RULES)
    return f"""
    with parts as (select page_id, {host} as host, {path} as path from pages),
    named as (
        select *, case when host <> '' then
            regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/$', '') end as canonical
        from parts),
    rules(action, rule_host, rule_path) as (values {values}),
    fits as (
        select p.host, p.path, r.rule_host || r.rule_path as rule, r.action,
            row_number() over (partition by p.host, p.path order by length(r.rule_host || r.rule_path) desc, r.action desc) as place
        from (select distinct host, path from parts) p
        join rules r on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)),
    listed as (select canonical from named where canonical is not null group by canonical having count(*) >= {LISTED_FROM})
    select n.page_id, n.host, n.path, f.rule,
        coalesce(f.action, case when l.canonical is not null then 'block' else 'allow' end) as verdict,
        case when f.action is null then l.canonical is not null end as listed
    from named n
    left join fits f on f.host = n.host and f.path = n.path and f.place = 1
    left join listed l on l.canonical = n.canonical"""
