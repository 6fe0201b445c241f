"""Byte-level BPE: a segment tree over byte positions finds the next merge, and decoding.

A piece of text starts as one token per byte. Leaf i of a segment tree holds the rank of the
pair that the token starting at byte i makes with the token after it, or none; every node holds
the least rank below it and the leftmost leaf that has it, so the root names the next merge. A
merge changes three leaves: the one where the new token starts, the one of its live neighbour on
the left, and the one where the right token started, which starts none any more. Each of these
point updates climbs one path of the tree, so a piece of n bytes takes n log n steps, whatever its
merges. A token's end is known from its length, its left neighbour from the length stored at the
neighbour's last byte; a node is one number, rank * n + place, so the least is the leftmost.

The rank of a pair is that of its joined bytes in the rank file; a piece that the file lists is
one token. Pieces are the matches of a pattern, each encoded by itself. Decoding joins the bytes
of the ids.

Texts are taken in stretches that end where a blank between two words starts a new piece, so
memory per text is a stretch's, or a piece's where that is longer. Pieces of up to 256 characters
are remembered, a bounded number of them. Rows never meet, so there is no shuffle.

Defined results: a null or empty text has no ids and decodes to nothing; every text has ids, as
all single bytes have a rank; special tokens' strings are ordinary text; rows with one doc_id are
rows of their own; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rxtrail.llm.letters import parts
from rxtrail.llm.shared import Memo, text_or_empty

MEMO_PIECES = 600_000
STRETCH = 1 << 18
#: A blank between two words always starts a piece.
_blank_between_words = regex.compile(r"(?<=\S) (?=\S)")


class Ranks:
    """A rank file: the bytes of every token, in base 64, and its rank, which is its id."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.bytes = {rank: token for token, rank in self.rank.items()}
        self.pattern = regex.compile(pattern)


class PairTree:
    """Segment tree over the byte positions of a piece: leftmost pair of least rank.

    Node i has children 2 i and 2 i + 1, the leaves are the last ``places`` nodes, and the root
    is node 1. A pair that is none counts as ``none``, which is more than any rank and place.
    """

    none = 1 << 62

    def __init__(self, ranks: list[int | None]):
        self.places = n = len(ranks)
        leaves = [self.none if rank is None else rank * n + i for i, rank in enumerate(ranks)]
        # Beyond small pieces 8 bytes a node count.
        self.node = node = [0] * n + leaves if n < 4096 else array("q", bytes(8 * n)) + array("q", leaves)
        for i in range(n - 1, 0, -1):
            a, b = node[2 * i], node[2 * i + 1]
            node[i] = a if a < b else b

    def set(self, place: int, rank: int | None) -> None:
        """Point update: the pair that starts at a byte has this rank, or is none."""
        node, i = self.node, self.places + place
        least = node[i] = self.none if rank is None else rank * self.places + place
        while i > 1:
            beside = node[i ^ 1]
            if beside < least:
                least = beside
            i >>= 1
            if node[i] == least:
                return
            node[i] = least

    def least(self) -> int:
        """Where the leftmost pair of least rank starts, -1 if there is no pair."""
        least = self.node[1] if self.places else self.none
        return -1 if least == self.none else least % self.places


def encode_piece(piece: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of one match of the pattern."""
    if (whole := rank.get(piece)) is not None:
        return [whole]
    n, get = len(piece), rank.get
    # A token's length, at its first byte and at its last one.
    length = [1] * n if n < 4096 else array("i", [1]) * n
    tree = PairTree([get(piece[i : i + 2]) for i in range(n - 1)])
    update = tree.set
    while (left := tree.least()) >= 0:
        right = left + length[left]
        end = right + length[right]
        length[left] = length[end - 1] = end - left
        if end < n:
            update(right, None)
            update(left, get(piece[left : end + length[end]]))
        else:  # the last token of the piece starts no pair
            update(left, None)
            if right < n - 1:
                update(right, None)
        if left:
            before = left - length[left - 1]
            update(before, get(piece[before:end]))
    ids, i = [], 0
    while i < n:
        ids.append(rank[piece[i : i + length[i]]])
        i += length[i]
    return ids


class Codec:
    """Ids of texts and bytes of ids; short pieces are remembered as 32-bit ids."""

    def __init__(self, path: str, pattern: str):
        self.ranks = Ranks(path, pattern)
        self.known = Memo(MEMO_PIECES, self._piece)
        self.decimal = {i: str(i) for i in self.ranks.bytes}

    def _piece(self, piece: str) -> bytes:
        return array("I", encode_piece(piece.encode("utf-8", "replace"), self.ranks.rank)).tobytes()

    def encode(self, text: str) -> Iterator[array]:
        """Ids of the text, stretch by stretch."""
        start = 0
        while start < len(text):
            cut = _blank_between_words.search(text, start + STRETCH)
            end = cut.start() if cut else len(text)
            stretch = text[start:end] if start or cut else text
            yield array("I", b"".join(map(self.known.__getitem__, parts(self.ranks.pattern, stretch))))
            start = end

    def decode(self, ids: array | list[int]) -> bytes:
        return b"".join(map(self.ranks.bytes.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process, file and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encoded(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and the array of its ids."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = codec(ranks, pattern)
        for batch in batches:
            ids = [list(chain.from_iterable(way.encode(text.as_py()))) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    return rows.mapInArrow(of, f"doc_id {_kind(docs)}, ids array<int>")


def decoded(ids: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and the bytes of its ids; null ids have none."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = codec(ranks, pattern)
        for batch in batches:
            data = [way.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], ["doc_id", "bytes"])

    return ids.select("doc_id", "ids").mapInArrow(of, f"doc_id {_kind(ids)}, bytes binary")


def report(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the bytes decoded from them.

    Ids are decoded stretch by stretch, as they come, so no document's ids are held whole.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        way = codec(ranks, pattern)
        decimal = way.decimal.__getitem__
        for batch in batches:
            counts, of_ids, of_bytes = [], [], []
            for text in batch.column(1):
                n, ids_digest, bytes_digest = 0, hashlib.sha256(), hashlib.sha256()
                for ids in way.encode(text.as_py()):
                    ids_digest.update((" " * (n > 0) + " ".join(map(decimal, ids))).encode())
                    bytes_digest.update(way.decode(ids))
                    n += len(ids)
                counts.append(n)
                of_ids.append(ids_digest.hexdigest())
                of_bytes.append(bytes_digest.hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    return rows.mapInArrow(of, f"doc_id {_kind(docs)}, n_tokens long, ids_sha256 string, decoded_sha256 string")
