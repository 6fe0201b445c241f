"""Exact deduplication over batches, and groups of a third of the rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.compare import rows_of_spark
from rxtrail.llm import exact, shared

SCHEMA = "doc_id long, text string, digest string, place int, batch string"


def batches(spark, tmp_path):
    """Three batches: copies within one and over several, upper case, nulls, empty texts, one row twice."""
    first = [(i, f"Text {i % 40}", "x", 1, "y") for i in range(100)]
    second = [(200 + i, f"tEXT {30 + i % 20}", "x", 1, "y") for i in range(60)] + [(5, None, "x", 1, "y"), (6, "", "x", 1, "y")]
    third = [(50, "text 3", "x", 1, "y"), (900, "Text 3", "x", 1, "y"), (None, "text 4", "x", 1, "y"), (7, "", "x", 1, "y")] + first[:3]
    for k, rows in enumerate((first, second, third)):
        spark.createDataFrame(rows, SCHEMA).repartition(2).write.parquet(f"{tmp_path}/in{k}")
        yield f"b{k}", rows, spark.read.parquet(f"{tmp_path}/in{k}")


def wanted(rows, so_far):
    """doc_id, keep_id and group_size of ``rows``, as they stand with all rows so far."""
    norm = lambda t: (t or "").translate(shared.ASCII_LOWER)
    ids = {}
    for r in so_far:
        ids.setdefault(norm(r[1]), []).append(r[0])
    largest = lambda found: max(found, key=lambda i: (i is not None, i))
    return Counter((r[0], largest(ids[norm(r[1])]), len(ids[norm(r[1])])) for r in rows)


def three(frame):
    return Counter((r.doc_id, r.keep_id, r.group_size) for r in frame.collect())


@pytest.mark.parametrize("digest", [exact.sha256, lambda text: F.substring(text, 1, 6)])
def test_state_goes_on_over_batches(spark, tmp_path, digest):
    """The second digest stands for several texts ("text 3" and "text 30" to "text 39", say)."""
    so_far, store = [], exact.DedupStore(spark, str(tmp_path / "store"), digest)
    for name, rows, docs in batches(spark, tmp_path):
        so_far += rows
        found = store.add(docs, name, shared.staging(spark))
        assert three(found) == wanted(rows, so_far), name
        again = exact.DedupStore(spark, str(tmp_path / "store"), digest).add(docs, name, shared.staging(spark))
        assert rows_of_spark(again) == rows_of_spark(found)
    if digest is exact.sha256:
        every = store.groups()
        assert three(every) == wanted(so_far, so_far)
        assert every.where("kept").count() == len({(r[1] or "").lower() for r in so_far})


def test_a_batch_left_before_the_stream_met_it_is_taken_up(spark, tmp_path):
    (one, first, docs), (two, second, more), _ = batches(spark, tmp_path)
    store = exact.DedupStore(spark, str(tmp_path / "store"))
    store._schema = docs.select(F.struct("*").alias("doc")).schema.add("batch", "string")
    store._store(docs, one)  # the driver is lost here
    found = store.add(more, two, shared.staging(spark))
    assert three(found) == wanted(second, first + second)
    assert three(store.add(docs, one, shared.staging(spark))) == wanted(first, first + second)
    with pytest.raises(ValueError):
        store.add(docs, "a/b", shared.staging(spark))


@pytest.mark.parametrize("large", [10_000, 2, 1])
def test_a_third_of_all_rows_are_copies(spark, tmp_path, monkeypatch, large):
    """With few large hits as with many, and with none, the same groups come out."""
    rows = [(i, "one text" if i % 3 == 0 else f"t {i // 5}", "x", 1, "y") for i in range(3000)]
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/in")
    monkeypatch.setattr(exact, "LARGE_HITS", large)
    found = exact.groups(spark.read.parquet(f"{tmp_path}/in"), shared.staging(spark))
    assert three(found) == wanted(rows, rows)
    assert found.where("kept").count() == len({r[1] for r in rows})


def test_batches_of_no_rows(spark, tmp_path):
    store = exact.DedupStore(spark, str(tmp_path / "store"))
    none = spark.createDataFrame([], SCHEMA)
    assert store.add(none, "none", shared.staging(spark)).count() == 0
    some = spark.createDataFrame([(1, "a", "x", 1, "y"), (2, "A", "x", 1, "y")], SCHEMA)
    assert three(store.add(some, "some", shared.staging(spark))) == Counter({(1, 2, 2): 1, (2, 2, 2): 1})
    assert store.add(none, "none2", shared.staging(spark)).count() == 0


def test_only_batches_that_hits_name_are_read_again(spark, tmp_path, monkeypatch):
    store, read, apart = exact.DedupStore(spark, str(tmp_path / "store")), [], exact._apart

    def seen(others, kept):
        filters = re.findall(r"PartitionFilters: \[(.*?)\]", kept._jdf.queryExecution().executedPlan().toString())
        read.append(set(re.findall(r"\bb[0-9]\b", " ".join(filters))))
        return apart(others, kept)

    monkeypatch.setattr(exact, "_apart", seen)
    for k, texts in enumerate((["a", "b"], ["c", "d"], ["e", "A"], ["f"])):
        docs = spark.createDataFrame([(-10 * k - i, t, "x", 1, "y") for i, t in enumerate(texts)], SCHEMA)
        store.add(docs, f"b{k}", shared.staging(spark))
    assert read == [set(), set(), {"b0"}, set()]
