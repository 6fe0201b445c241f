"""The training-corpus pipeline: clean, drop copies and near copies, mix, encode.

Each stage takes the documents that its predecessor kept, written as Parquet and read again,
and returns documents in the same columns; the last returns ids. SQL has no counterpart for
SimHash and BPE, so ``ORACLE_SQL`` is None and tests hold ``run`` against brute force.

Defined results: a null or empty text has too few words and goes in the first stage; of equal
texts, repeated rows included, one row with the largest doc_id stays, of near copies one with the
smallest, and a null id only if there is no other; a null source is a source of its own, the last
one; rows without an id draw alike in the mix; columns beside doc_id, text, n_chars and source are
carried along unread, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rxtrail.llm import bpe, exact, mixing, quality, simhash
from rxtrail.llm.queries import TOKENIZER
from rxtrail.llm.shared import documents, small_batches, staging

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.cleaned(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.kept(docs, staging(spark))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.kept(docs, staging(small_batches(spark)))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs, staging(spark))


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.report(docs, TOKENIZER)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("simhash near dedup", simhash_dedup),
    ("source mix", source_mix),
    ("bpe encoding", bpe_codec),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = staging(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = store.write(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
