"""The registered queries on the corpus tables, and SQL for those that it can express.

Each applies its operator, with production parameters, to the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rxtrail.llm import bpe, bytebpe, exact, html, mixing, pii, quality, runs, simhash, substring, tokenfile, toxicity, trie
from rxtrail.llm.shared import documents, small_batches, staging

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_pii_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(documents(spark, sf_dir))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(documents(spark, sf_dir))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.report(documents(spark, sf_dir), staging(spark), TOKENIZER)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(documents(spark, sf_dir))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(documents(spark, sf_dir), staging(spark))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(documents(spark, sf_dir), TOKENIZER)


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extracted(small_batches(spark).read.parquet(f"{sf_dir}/pages.parquet"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.report(documents(spark, sf_dir), staging(spark))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(documents(spark, sf_dir), staging(spark))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.report(documents(spark, sf_dir), labels, staging(spark))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.report(runs.with_planted_runs(documents(spark, sf_dir)))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = small_batches(spark).read.parquet(f"{sf_dir}/conversations.parquet")
    return trie.nodes(trie.rebuilt(turns), staging(spark))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytebpe.report(documents(spark, sf_dir), RANKS, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pii_trees,
        op2_substring_dedup,
        op3_token_store,
        op4_quality_rules,
        op5_simhash_dedup,
        op6_bpe_codec,
        op7_html_text,
        op8_exact_dedup,
        op9_source_mix,
        op10_toxicity,
        op11_periodic_runs,
        op12_prefix_trie,
        op13_byte_bpe,
    )
}

SQL = {
    "op2_substring_dedup": substring.SQL_REPORT,
    "op4_quality_rules": quality.SQL_REPORT,
    "op8_exact_dedup": exact.SQL_REPORT,
    "op9_source_mix": mixing.SQL_REPORT,
    "op12_prefix_trie": trie.SQL_REPORT,
}
