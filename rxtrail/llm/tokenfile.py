"""Token ids in files: one id array per block, document ends in Elias-Fano form.

A token store is a folder of Parquet files whose rows are blocks, in order of shard and block:

* ``ids``: the ids of the block's documents one after another, little-endian, 16 bits each if
  the vocabulary allows, else 32; each document ends with the end id;
* ``low``, ``high``, ``low_bits``, ``samples``: where documents end. Of an end e, the low bits
  are stored as they are, the rest as the position of a one in ``high`` (bit (e >> low_bits) + i
  for document i), about two bits a document besides the low ones. ``samples`` holds the place
  of every 64th one in 32 bits, so an end is found by one sample and a scan of few bytes;
* ``doc_ids``, ``n_docs``, ``n_ids``.

Spark writes the blocks, so any file system will do and a lost task is written again. Documents
are dealt to shards by ranges of id and stay whole; a block closes at a million ids. Reading
needs no id table: every offset within a block is selected, and blocks' starts are sums of
``n_ids``. Given documents are read by their places alone.

Defined results: a null text is empty and holds the end id alone; null ids come first; rows
with one id follow each other in order of a hash of their text; an empty table makes an empty
store.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rxtrail.llm.shared import Memo, byte_symbols, text_or_empty
from rxtrail.sources.staging import Staging

END_ID = 1
BLOCK_IDS = 1 << 20
SAMPLE = 64
MEMO_WORDS = 500_000


class EliasFano:
    """A rising list of numbers in near-minimal space, with random access."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        if not n:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(np.log2(max(1, int(values[-1]) // n))))
        ones = (values >> low_bits) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1, np.uint8)
        high[ones] = 1
        low = (values[:, None] >> np.arange(low_bits) & 1).astype(np.uint8)
        return cls(
            n,
            low_bits,
            np.packbits(low.ravel(), bitorder="little").tobytes(),
            np.packbits(high, bitorder="little").tobytes(),
            ones[::SAMPLE].astype("<u4").tobytes(),
        )

    def select(self, i: int) -> int:
        """Place of the i-th one, from the sample before it and the bytes that follow."""
        place = int(np.frombuffer(self.samples, "<u4")[i // SAMPLE])
        left = i % SAMPLE
        byte, bit = divmod(place, 8)
        rest = self.high[byte] >> bit << bit
        while left >= (ones := rest.bit_count()):
            left -= ones
            byte += 1
            rest = self.high[byte]
        for _ in range(left):
            rest &= rest - 1
        return byte * 8 + (rest & -rest).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        first = i * self.low_bits
        last = first + self.low_bits
        whole = int.from_bytes(self.low[first // 8 : (last + 7) // 8], "little")
        low = whole >> first % 8 & (1 << self.low_bits) - 1
        return (self.select(i) - i) << self.low_bits | low

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little", count=self.n * self.low_bits)
        low = (bits.reshape(self.n, self.low_bits).astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return (ones[: self.n] - np.arange(self.n)) << self.low_bits | low


class WordEncoder:
    """Ids of texts by the tokenizers library, remembered by word.

    The normalizer makes every run of white space one blank and the pre-tokenizer drops blanks,
    so no token spans one: a text's ids are those of its words in turn. The library is asked
    for a word's core: letters are lower-cased by the normalizer anyway, and a sentence mark
    after a letter is a word of its own to the pre-tokenizer. Special tokens are found before
    letters are lower-cased, so words that would turn into one are left as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.symbols = byte_symbols()
        self.known = Memo(MEMO_WORDS, self._word)

    def _word(self, word: str) -> bytes:
        """Ids of a word, as they are stored."""
        # Latin letters are all composed, and all but dotted capital I are lower-cased one to one.
        if word and max(word) <= "\u024f" and "\u0130" not in word:
            low = word.lower()
            if len(low) > 1 and low[-1] in ".,!?;:" and low[:-1].isalpha():
                return self.known[low[:-1]] + self.known[low[-1]]
            if low != word and not any(s in low for s in self.special):
                return self.known[low]
            if word.isalpha():  # one word to the pre-tokenizer, and in normal form already
                symbols = "".join(map(self.symbols.__getitem__, word.encode()))
                return np.array([t.id for t in self.model.tokenize(symbols)], self.width).tobytes()
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, self.width).tobytes()

    def batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many texts, each with the end id behind, one after another; and how many each has.

        Words are numbered by Arrow, so each distinct word is looked up once, and its ids are
        gathered for every place where it stands.
        """
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        of_word = [self.known[word] for word in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, of_word), np.int32, len(of_word)) // np.dtype(self.width).itemsize
        bounds = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        lists = pa.ListArray.from_arrays(bounds, pa.array(np.frombuffer(b"".join(of_word), self.width)))
        ids = lists.take(coded.indices).flatten().to_numpy(zero_copy_only=False)
        word_ends = np.r_[0, np.cumsum(sizes[coded.indices.to_numpy(zero_copy_only=False)], dtype=np.int64)]
        ends = word_ends[split.offsets.to_numpy()]
        return np.insert(ids, ends[1:], end_id), np.diff(ends) + 1


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and file."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


BLOCK = (
    "shard int, block int, n_docs long, n_ids long, width string, doc_ids array<{id}>, ids binary, "
    "low_bits int, low binary, high binary, samples binary"
)


def _blocks(path: str, end_id: int, block_ids: int, id_type: pa.DataType):
    def row(shard: int, block: int, width: str, doc_ids: list, parts: list[np.ndarray], sizes: list[np.ndarray]) -> pa.RecordBatch:
        ends = np.cumsum(np.concatenate(sizes))
        index = EliasFano.of(ends)
        values = [shard, block, len(ends), int(ends[-1]), width, doc_ids, np.concatenate(parts).tobytes()]
        values += [index.low_bits, index.low, index.high, index.samples]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(id_type), pa.binary()]
        types += [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        names = ["shard", "block", "n_docs", "n_ids", "width", "doc_ids", "ids", "low_bits", "low", "high", "samples"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, doc_ids, parts, sizes, held = TaskContext.get().partitionId(), 0, [], [], [], 0
        encode = encoder(path)
        for batch in batches:
            ids, lengths = encode.batch(batch.column(1), end_id)
            ends, first = np.r_[0, np.cumsum(lengths)], 0
            while first < batch.num_rows:
                # Up to the document with which the block is full.
                last = int(np.searchsorted(ends, ends[first] + block_ids - held))
                last = min(max(last, first + 1), batch.num_rows)
                doc_ids += batch.column(0)[first:last].to_pylist()
                parts.append(ids[ends[first] : ends[last]])
                sizes.append(lengths[first:last])
                held += int(ends[last] - ends[first])
                if held >= block_ids:
                    yield row(shard, block, encode.width, doc_ids, parts, sizes)
                    block, doc_ids, parts, sizes, held = block + 1, [], [], [], 0
                first = last
        if doc_ids:
            yield row(shard, block, encode.width, doc_ids, parts, sizes)

    return of


def write_store(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS
) -> None:
    """Encode ``docs`` and write them as a token store in ascending order of doc_id."""
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text").alias("tie")
    rows = docs.select("doc_id", text_or_empty("text").alias("text")).select("*", tie)
    order = ["doc_id", "tie"]
    kind = docs.schema["doc_id"].dataType
    id_type = pa.from_numpy_dtype("int64") if kind.simpleString() == "bigint" else pa.string()
    if kind.simpleString() not in ("bigint", "string"):
        raise TypeError("doc_id is to be a long or a string")
    blocks = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).drop("tie")
    blocks = blocks.mapInArrow(_blocks(tokenizer, end_id, block_ids, id_type), BLOCK.format(id=kind.simpleString()))
    blocks.write.option("compression", "zstd").parquet(path)


class Block:
    """One row of a store: where a document's ids are is told by select alone."""

    def __init__(self, batch: pa.RecordBatch, b: int):
        one = lambda name: batch.column(name)[b].as_py()
        self.n_docs = one("n_docs")
        self.ends = EliasFano(self.n_docs, one("low_bits"), one("low"), one("high"), one("samples"))
        self.ids = np.frombuffer(batch.column("ids")[b].as_buffer(), one("width"))

    def bounds(self, i: int) -> tuple[int, int]:
        return self.ends[i - 1] if i else 0, self.ends[i]


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in range(batch.num_rows):
            block, start, rows = Block(batch, b), 0, []
            for i in range(block.n_docs):
                end = block.ends[i]
                rows.append((start, end - start, zlib.crc32(block.ids[start:end].astype("<u4"))))
                start = end
            same = [np.full(len(rows), batch.column(name)[b].as_py(), np.int32) for name in ("shard", "block")]
            numbers = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, same), batch.column("doc_ids")[b].values, *numbers],
                ["shard", "block", "doc_id", "first", "n_tokens", "ids_crc32"],
            )


STORED = ["n_docs", "width", "ids", "low_bits", "low", "high", "samples"]


def _read_given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in range(batch.num_rows):
            block = Block(batch, b)
            wanted = batch.column("wanted")[b].as_py()
            ids = [block.ids[slice(*block.bounds(w["place"]))].astype(np.int32) for w in wanted]
            found = pa.array([w["doc_id"] for w in wanted], batch.schema.field("doc_ids").type.value_type)
            yield pa.RecordBatch.from_arrays([found, pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def read_given(spark: SparkSession, path: str, doc_ids: DataFrame) -> DataFrame:
    """doc_id and ids of given documents, end id included; ids that aren't in the store give none.

    Only the lists of doc_ids are read of all blocks; of those that hold a wanted document each
    one's two offsets are selected, and nothing else of the index is decoded.
    """
    blocks = spark.read.parquet(path)
    places = blocks.select("shard", "block", F.posexplode("doc_ids").alias("place", "doc_id"))
    wanted = places.join(doc_ids.select("doc_id").distinct(), "doc_id").groupBy("shard", "block")
    wanted = wanted.agg(F.collect_list(F.struct("place", "doc_id")).alias("wanted"))
    held = blocks.select("shard", "block", "doc_ids", *STORED).join(wanted, ["shard", "block"])
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    return held.mapInArrow(_read_given, f"doc_id {kind}, ids array<int>")


def read_documents(spark: SparkSession, path: str, staging: Staging) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document of a store, from its files."""
    blocks = spark.read.parquet(path)
    sizes = staging.write(blocks.groupBy("shard", "block").agg(F.sum("n_ids").alias("n")), "sizes")
    # One row per shard: shards are as many as write_store made partitions.
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n"))
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("shard", earlier(W.orderBy("shard")).alias("shard_start"))
    within = sizes.select("shard", "block", earlier(W.partitionBy("shard").orderBy("block")).alias("block_start"))
    starts = staging.write(within.join(shards, "shard"), "starts")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    docs = blocks.select("shard", "block", "doc_ids", *STORED).mapInArrow(
        _read, f"shard int, block int, doc_id {kind}, first long, n_tokens long, ids_crc32 long"
    )
    start = F.col("shard_start") + F.col("block_start") + F.col("first")
    return docs.join(starts, ["shard", "block"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def report(docs: DataFrame, staging: Staging, tokenizer: str) -> DataFrame:
    path = staging.new_path("tokens")
    write_store(docs.select("doc_id", "text"), path, tokenizer)
    return read_documents(docs.sparkSession, path, staging)
