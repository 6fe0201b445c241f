"""Source mixing: nearness to targets, any number of sources, hot and cold ones."""

import random
from itertools import cycle

import pytest

import corpus_pipeline
from checks.compare import duckdb_over, rows_of_spark, rows_of_sql
from rxtrail.llm import mixing, shared

SCHEMA = "doc_id long, text string, source string, size int, of string, seed int"


def stored(spark, rows, path):
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    return shared.documents(spark, str(path))


def by_source(rows):
    """words, target and words taken of each source, by size and target."""
    found = {}
    for r in rows:
        n, _, taken = found.get((r.source_size, r.target), (0, 0, 0))
        found[r.source_size, r.target] = (n + r.size, r.target, taken + r.taken)
    return found.values()


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_every_source_comes_near_its_target(spark, sf):
    rows = mixing.report(shared.documents(spark, f"/root/testdata/{sf}"), shared.staging(spark)).collect()
    assert all(0 <= r.taken <= 3 * r.size for r in rows)
    for n, target, taken in by_source(rows):
        assert abs(taken - target) <= 0.05 * target, (n, target, taken)


@pytest.mark.parametrize("most", [100_000, 40])
def test_as_many_sources_as_documents_beside_a_hot_one(spark, tmp_path, monkeypatch, most):
    """1500 sources of one document, one with a third of all, texts without words, no source."""
    pick = random.Random(11)
    text = lambda: " ".join("w" for _ in range(pick.randrange(0, 60)))
    rows = [(i, text(), f"u{i:04d}", 1, "x", 2) for i in range(1500)]
    rows += [(2000 + i, text(), "hot é", 1, "x", 2) for i in range(700)]
    rows += [(3000, None, "empty", 1, "x", 2), (None, "a b", None, 1, "x", 2), (None, "c", "u0001", 1, "x", 2)]
    docs = stored(spark, rows + rows[:2], tmp_path)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", most)
    frame = mixing.report(docs, shared.staging(spark))
    assert rows_of_spark(frame) == rows_of_sql(duckdb_over(str(tmp_path)), mixing.SQL_REPORT)
    total = sum(r.size for r in frame.collect())
    assert abs(sum(r.taken for r in frame.collect()) - total) < 0.05 * total
    copies = mixing.repeated(docs, shared.staging(spark))
    assert copies.columns == docs.columns
    taken = copies.select(mixing.words(mixing.text_or_empty("text")).alias("w")).selectExpr("sum(size(w)) AS n").first().n
    assert taken == sum(r.taken for r in frame.collect())


def test_targets_need_no_task_with_all_sources(spark, tmp_path):
    """Windows run within ranges of sources, or over one row for each range."""
    docs = stored(spark, [(i, "a b c", f"s{i:05d}", 1, "x", 2) for i in range(5000)], tmp_path)
    sized = docs.selectExpr("source", "3L AS size")
    store = shared.staging(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        targets = mixing.source_targets(sized, store)
        assert targets.agg({"target": "sum"}).first()[0] == pytest.approx(15_000)
        weighed = spark.read.parquet(f"{store.folder}/*-weighed").selectExpr("_metadata.file_path AS f")
        sizes = [r["count"] for r in weighed.groupBy("f").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 4 and max(sizes) < 2500


def targets_of(sizes):
    """Each source's target: the sources that their share would fill are taken out until none is."""
    weights, full = dict(zip(sorted(sizes), cycle(mixing.WEIGHTS), strict=False)), set()
    while True:
        room = sum(sizes.values()) - 3 * sum(sizes[s] for s in full)
        others = sum(weights[s] for s in sizes if s not in full)
        more = {s for s in sizes if s not in full and 3 * sizes[s] * others < weights[s] * room}
        if not more:
            return {s: 3 * n if s in full else weights[s] * room / others for s, n in sizes.items()}
        full |= more


@pytest.mark.parametrize("words", [430_000_000, 1_200_000_000, 2**31 - 1, 2**31, 10**12])
def test_targets_of_billions_of_words(spark, words):
    """Shares out of totals on both sides of 2^31; 6 GB of documents have about 1.6 billion words."""
    sizes = {"a": words // 100, "b": words // 2, "c": words // 10, "d": words // 5}
    sizes["e"] = words - sum(sizes.values())
    sized = spark.createDataFrame([(s, n - n // 2) for s, n in sizes.items()] + [(s, n // 2) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r for r in mixing.source_targets(sized, shared.staging(spark)).collect()}
    assert {s: r.source_size for s, r in found.items()} == sizes
    assert {s: r.target for s, r in found.items()} == pytest.approx(targets_of(sizes), rel=1e-12)


def weights_times(monkeypatch, n):
    """The same shares by numbers as large as those of n times the words."""
    scaled = tuple(n * w for w in mixing.WEIGHTS)
    monkeypatch.setattr(mixing.source_targets, "__defaults__", (scaled, mixing.MOST_REPEATS))


def test_the_mix_stage_at_totals_beyond_an_int(spark, tmp_path, monkeypatch):
    docs = stored(spark, [(i, "a b " * (i % 7), f"s{i % 4}", 1, "x", 2) for i in range(200)], tmp_path)
    mixed = lambda: sorted(r.doc_id for r in corpus_pipeline.source_mix(spark, docs, str(tmp_path)).collect())
    expected = mixed()
    weights_times(monkeypatch, 10**8)
    assert mixed() == expected != []


def test_the_report_at_totals_beyond_an_int(spark, tmp_path, monkeypatch):
    rows = [(i, "a b " * (i % 9), f"s{i % 5}", 1, "x", 2) for i in range(200)]
    docs = stored(spark, [*rows, (300, "c " * 400, None, 1, "x", 2), (None, None, "s1", 1, "x", 2)], tmp_path)
    weights_times(monkeypatch, 10**8)
    frame = mixing.report(docs, shared.staging(spark))
    assert rows_of_spark(frame) == rows_of_sql(duckdb_over(str(tmp_path)), mixing.SQL_REPORT)
