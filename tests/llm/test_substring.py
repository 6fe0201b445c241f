"""Lanes of removals, rows without ids, and SQL."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.compare import rows_of_spark, rows_of_sql
from rxtrail.llm import shared, substring

PASSAGES = [" ".join(f"p{k}w{i}" for i in range(n)) for k, n in enumerate((13, 20, 60, 12))]


def made(ids, seed=61):
    pick = random.Random(seed)
    return [(i, " ".join(pick.choice([*PASSAGES, f"own{i} words{pick.randrange(5)} here"]) for _ in range(pick.randrange(1, 9)))) for i in ids]


def frame(spark, rows):
    return shared.small_batches(spark).createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, lane int, doc_key int")


def brute(rows, order):
    known = [(order(i, t), (t or "").split()) for i, t in rows]
    least: dict = {}
    for key, w in known:
        for k in range(len(w) - 12):
            least[tuple(w[k : k + 13])] = min(least.get(tuple(w[k : k + 13]), key), key)
    out = Counter()
    for (i, _), (key, w) in zip(rows, known, strict=True):
        gone = {k + j for k in range(len(w) - 12) if least[tuple(w[k : k + 13])] < key for j in range(13)}
        out[i, len(w), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


def test_hash_is_sparks(spark):
    keys = np.array([0, 1, -1, 8, 2**62, -(2**63), 2**63 - 1, *range(1000, 9000, 16)], np.int64)
    frame = spark.createDataFrame([(int(k),) for k in keys], "k long").select("k", F.xxhash64("k").alias("h"))
    assert dict(zip(keys.tolist(), substring.hashed(keys).view(np.int64).tolist(), strict=True)) == {r.k: r.h for r in frame.collect()}


def test_ids_of_one_remainder_spread():
    for lanes in (8, 64, 1000):
        counts = np.bincount(substring.lanes_of(np.arange(0, lanes * 64 * 50, lanes), lanes), minlength=lanes)
        assert counts.max() < 4 * counts.mean() + 20


@pytest.mark.parametrize("lane_bytes", [32 << 20, 200])
def test_ids_of_one_remainder(spark, lane_bytes):
    rows = made(range(-160, 1600, 16))
    found = substring.cleaned(frame(spark, rows), run_words=150, lane_bytes=lane_bytes)
    assert Counter((r.doc_id, r.n_words, r.kept) for r in found.collect()) == brute(rows, lambda i, t: i)


def test_rows_without_ids_come_last_by_their_text(spark):
    rows = made([None] * 70) + made(range(0, 40, 8), 62) + [(None, None), (3, None), (None, "")]
    texts = frame(spark, rows).select("text", F.xxhash64(shared.text_or_empty("text")).alias("h")).distinct().collect()
    tag = {r.text or "": r.h % (1 << 44) for r in texts}
    found = substring.cleaned(frame(spark, rows), run_words=150, lane_bytes=300)
    order = lambda i, t: (1, -tag[t or ""]) if i is None else (0, i)
    assert Counter((r.doc_id, r.n_words, r.kept) for r in found.collect()) == brute(rows, order)


def test_sql(spark):
    docs = frame(spark, [*made(range(60)), (100, None), (101, " \n"), (102, "é\x85x " * 20)])
    documents = docs.select("doc_id", "text").toArrow()  # noqa: F841
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents AS SELECT * FROM documents")
    assert rows_of_spark(substring.report(docs)) == rows_of_sql(connection, substring.SQL_REPORT)
