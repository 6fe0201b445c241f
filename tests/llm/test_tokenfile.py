"""Blocks of a token store, random access and ids of strings."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from rxtrail.llm import shared, tokenfile
from rxtrail.llm.queries import TOKENIZER

LIBRARY = Tokenizer.from_file(TOKENIZER)


def made(n=90):
    pick = random.Random(41)
    word = lambda: "".join(pick.choice(["an", "The", "é", "İ", "!", "<|endoftext|>", "\x1c", "\t", "\n", "7"]) for _ in range(pick.randrange(1, 5)))
    return [" ".join(word() for _ in range(pick.randrange(30))) for _ in range(n)] + ["", " ", "\n\n", "a" * 5000]


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def test_batches_are_the_librarys():
    texts = made()
    ids, sizes = tokenfile.encoder(TOKENIZER).batch(pa.array(texts), 1)
    assert ids.tolist() == [i for t in texts for i in ids_of(t)] and sizes.tolist() == [len(ids_of(t)) for t in texts]
    ids, sizes = tokenfile.encoder(TOKENIZER).batch(pa.array([], pa.string()), 1)
    assert len(ids) == len(sizes) == 0


@pytest.mark.parametrize("kind", ["long", "string"])
@pytest.mark.parametrize("block_ids", [1, 50, 1 << 20])
def test_store(spark, kind, block_ids):
    texts = [*made(), None]
    rows = [(i if kind == "long" else f"d{i:03}", t, 1) for i, t in enumerate(texts)] + [(None, "no id", 2)]
    docs = shared.small_batches(spark).createDataFrame(rows, f"doc_id {kind}, text string, ids int").repartition(5)
    store = shared.staging(spark)
    path = store.new_path("tokens")
    tokenfile.write_store(docs, path, TOKENIZER, block_ids=block_ids)
    blocks = spark.read.parquet(path).collect()
    assert all(b.n_ids - len(ids_of(texts[-1])) < block_ids + 6000 for b in blocks)
    if block_ids == 1:
        assert all(b.n_docs == 1 for b in blocks)
    found = {r.doc_id: r for r in tokenfile.read_documents(spark, path, store).collect()}
    start = 0
    for doc_id, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        assert (found[doc_id].start, found[doc_id].n_tokens) == (start, len(ids_of(text)))
        start += len(ids_of(text))
    asked = [rows[k][0] for k in (3, 50, 91, 94)] + [10**6 if kind == "long" else "none"]
    wanted = spark.createDataFrame([(a,) for a in [*asked, asked[0]]], f"doc_id {kind}")
    given = {r.doc_id: list(r.ids) for r in tokenfile.read_given(spark, path, wanted).collect()}
    assert given == {i: ids_of(t) for i, t, _ in rows if i in asked}


def test_reading_never_decodes_whole_lists(spark, monkeypatch):
    values = np.cumsum(np.random.default_rng(5).integers(1, 900, 3000))
    index = tokenfile.EliasFano.of(values)
    monkeypatch.setattr(tokenfile.EliasFano, "all", None)
    assert [index[i] for i in (0, 63, 64, 65, 2999)] == [values[i] for i in (0, 63, 64, 65, 2999)]
