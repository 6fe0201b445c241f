"""BPE encoding by a transducer with bounded lookahead, and decoding by a state machine.

Merges apply in order of rank. Take a text and a longer one that begins with it: in the part
that both share, the two differ only right of a frontier, at first the shorter text's end. A
merge (u, v) moves the frontier left, by the length of u, only if u ends there and v, in one
of the two, starts there. The next such merge has a later rank, and its right part starts
with u: u lies on the left spine of its derivation. So the frontier moves at most by the
longest chain of left parts in which ranks rise and each right part has the left part before
it on its spine. ``lookahead`` computes that chain once per merge list; tokens that end so
many symbols before the end of what is read are final, whatever follows.

The transducer reads symbols into a buffer of fixed size, emits tokens that are final and
keeps the rest. All words go through it. A text is read in stretches that end at a blank, and a
word longer than that in stretches too, cut where neither the normal form nor a part of the word
depends on what comes next but for going on; so a text or word of any length takes the memory of
a stretch, the buffer and a bounded memo of words of up to 256 characters.

Decoding goes id by id: pieces become bytes, and an incremental UTF-8 decoder emits characters
as they complete. A file without a decoder joins its tokens' strings by blanks, as the library
does; ``plain=True`` gives bytes and word ends their meaning instead.

Defined results: a null or empty text has no ids and decodes to nothing; white space makes no
tokens; the special tokens' strings in a text become their ids, as in the library.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from itertools import islice, pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtrail.llm.letters import normal, parts
from rxtrail.llm.shared import LONGEST_KEY, Memo, byte_symbols, text_or_empty

MEMO_WORDS, MEMO_PARTS = 80_000, 200_000
#: Characters of a stretch, and ids that are handed on at once.
STRETCH = 1 << 16
PIECE_IDS = 1 << 15
SHORT = 48

# What the file's pattern takes as one part: contractions, letters, a number, others.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
PARTS = "|".join(CONTRACTIONS) + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS, OTHERS = regex.compile(r"\A\p{L}+"), regex.compile(r"\A[^\s\p{L}\p{N}]+")


class BpeModel:
    """A byte-level merge list with word ends, as in a file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        model = config["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in config["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.added.items()}
        ranked = [(self.vocab[a], self.vocab[b]) for a, b in model["merges"]]
        self.pairs = {two: rank for rank, two in enumerate(ranked)}
        self.merged = [self.vocab[a + b] for a, b in model["merges"]]
        self.none = len(ranked)
        symbols = byte_symbols()
        self.inner = [self.vocab[s] for s in symbols]
        self.final = [self.vocab[s + self.suffix] for s in symbols]
        steps = config["pre_tokenizer"]["pretokenizers"]
        if steps[0]["pattern"]["Regex"] != PARTS:
            raise ValueError("the file's pattern is another one than words are cut by here")
        self.pattern = regex.compile(PARTS)
        self.special = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.lookahead, self.length = lookahead(ranked, self.merged)

    def normalise(self, text: str) -> str:
        """NFC, then lower case character by character, both as the library has them."""
        return normal(text)


def lookahead(pairs: list[tuple[int, int]], merged: list[int]) -> tuple[int, dict[int, int]]:
    """Symbols after which nothing that follows can change a token (see the module's head), and
    the length in symbols of each merged token. Pairs come in order of rank."""
    length: dict[int, int] = {}
    parts: dict[int, tuple[int, int]] = {}
    reach: dict[int, int] = {}  # by left part, the longest chain that ends in it
    most = 0
    for (left, right), token in zip(pairs, merged, strict=True):
        before, spine = 0, right
        while True:
            before = max(before, reach.get(spine, 0))
            if spine not in parts:
                break
            spine = parts[spine][0]
        chain = length.get(left, 1) + before
        reach[left] = max(reach.get(left, 0), chain)
        most = max(most, chain)
        if token in parts:
            raise ValueError("two merges make one token; the lookahead holds for lists without such")
        parts[token] = (left, right)
        length[token] = length.get(left, 1) + length.get(right, 1)
    return most + 1, length


def merge_all(symbols: list[int], model: BpeModel) -> list[int]:
    """Tokens of the symbols: merge the leftmost pair of least rank until there is none."""
    pair = model.pairs.get
    tokens, n = list(symbols), len(symbols)
    if n <= SHORT:
        none = model.none
        ranks = [pair(two, none) for two in pairwise(tokens)]
        while ranks and (rank := min(ranks)) != none:
            i = ranks.index(rank)
            tokens[i : i + 2] = [model.merged[rank]]
            del ranks[i]
            if i:
                ranks[i - 1] = pair((tokens[i - 1], tokens[i]), none)
            if i < len(ranks):
                ranks[i] = pair((tokens[i], tokens[i + 1]), none)
        return tokens
    # The same with a queue; a merged token stays at its first symbol's place.
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(rank, i) for i, two in enumerate(pairwise(tokens)) if (rank := pair(two)) is not None]
    heapq.heapify(queue)
    while queue:
        rank, i = heapq.heappop(queue)
        j = after[i] if tokens[i] >= 0 else n
        if j >= n or pair((tokens[i], tokens[j])) != rank:
            continue
        tokens[i], tokens[j] = model.merged[rank], -1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
            if (rank := pair((tokens[i], tokens[after[i]]))) is not None:
                heapq.heappush(queue, (rank, i))
        if before[i] >= 0 and (rank := pair((tokens[before[i]], tokens[i]))) is not None:
            heapq.heappush(queue, (rank, before[i]))
    return [t for t in tokens if t >= 0]


class Transducer:
    """Encodes one word whose symbols come bit by bit."""

    def __init__(self, model: BpeModel, buffer: int = 0):
        self.model = model
        self.size = max(buffer, 2 * model.lookahead, 4096 if not buffer else 0)
        self.held: list[int] = []

    def feed(self, data: bytes) -> Iterator[int]:
        """Read bytes that do not end the word; emit what is final."""
        inner = self.model.inner
        for i in range(0, len(data), self.size):
            self.held.extend(inner[b] for b in data[i : i + self.size])
            if len(self.held) > self.size:
                yield from self._stable()

    def _stable(self) -> Iterator[int]:
        end, final = 0, len(self.held) - self.model.lookahead
        for token in merge_all(self.held, self.model):
            size = self.model.length.get(token, 1)
            if end + size > final:
                break
            end += size
            yield token
        del self.held[:end]

    def finish(self, last: int) -> Iterator[int]:
        """Read the byte that ends the word; emit all that is left."""
        self.held.append(self.model.final[last])
        yield from merge_all(self.held, self.model)
        self.held = []


def _next_cut(text: str, place: int) -> int:
    """The first place from here on before which a word can be cut.

    What stands there must not combine with what precedes it, nor end a contraction.
    """
    while place < len(text):
        c = text[place]
        joins = unicodedata.category(c)[0] == "M" or 0x1160 <= ord(c) <= 0x11FF
        if not joins and not (c.isalpha() and "'" in text[max(0, place - 2) : place]):
            break
        place += 1
    return place


class Encoder:
    """Ids of texts, in pieces; short words are remembered, as 32-bit ids."""

    def __init__(self, model: BpeModel):
        self.model = model
        self.way = Transducer(model)
        self.known = Memo(MEMO_WORDS, self._remembered_word)
        self.parts = Memo(MEMO_PARTS, self._remembered_part)

    def _remembered_word(self, word: str) -> bytes:
        if len(word) > LONGEST_KEY or self.model.special and self.model.special.search(word):
            return array("I", self._word(word)).tobytes()
        return b"".join(map(self.parts.__getitem__, parts(self.model.pattern, self.model.normalise(word))))

    def _remembered_part(self, part: str) -> bytes:
        data, way = part.encode("utf-8", "replace"), self.way
        return array("I", [*way.feed(data[:-1]), *way.finish(data[-1])]).tobytes()

    def _word(self, word: str) -> Iterator[int]:
        """Ids of a text without blanks and line feeds, of any length."""
        last = 0
        for m in self.model.special.finditer(word) if self.model.special else ():
            yield from self._plain(word, last, m.start())
            yield self.model.added[m.group()]
            last = m.end()
        yield from self._plain(word, last, len(word))

    def _plain(self, word: str, start: int, end: int) -> Iterator[int]:
        """Ids of a stretch of a word without special tokens."""
        if end - start <= LONGEST_KEY:
            for part in parts(self.model.pattern, self.model.normalise(word[start:end])):
                yield from array("I", self.parts[part])
        else:
            yield from self._stretches(word, start, end)

    def _stretches(self, word: str, start: int, end: int) -> Iterator[int]:
        """The same, read bit by bit: a part that reaches a stretch's end goes on in the next."""
        way, run, held = Transducer(self.model), None, b""
        while start < end:
            cut = min(end, _next_cut(word, start + STRETCH))
            text, start = self.model.normalise(word[start:cut]), cut
            if run:  # what of this stretch belongs to the open part
                more = "".join(parts(run, text))
                data, text = held + more.encode("utf-8", "replace"), text[len(more) :]
                yield from way.feed(data[:-1])
                held = data[-1:]
                if not text:
                    continue
                yield from way.finish(held[0])
                run = None
            found = parts(self.model.pattern, text)
            for i, part in enumerate(found):
                data = part.encode("utf-8", "replace")
                yield from way.feed(data[:-1])
                if i + 1 == len(found) and start < end and text.endswith(part) and part not in CONTRACTIONS:
                    # Numbers are parts of their own; letters and others may go on.
                    run = next((r for r in (LETTERS, OTHERS) if parts(r, part)), None)
                    held = data[-1:]
                if not run:
                    yield from way.finish(data[-1])
        if run:
            yield from way.finish(held[0])

    def encode(self, text: str) -> Iterator[array]:
        """Ids of the text, piece by piece; no token spans a blank."""
        start, known = 0, self.known
        while start < len(text):
            ends = [e for e in (text.find(c, start + STRETCH) for c in " \n") if e >= 0]
            end = min(ends, default=len(text))
            words = text[start:end].replace("\n", " ").split(" ")
            start, first = end, 0
            for i, word in enumerate(words):
                if len(word) > LONGEST_KEY:
                    yield array("I", b"".join(map(known.__getitem__, words[first:i])))
                    ids, first = self._word(word), i + 1
                    while piece := array("I", islice(ids, PIECE_IDS)):
                        yield piece
            yield array("I", b"".join(map(known.__getitem__, words[first:])))


class Decoder:
    """Bytes of tokens to text, as characters complete."""

    def __init__(self, model: BpeModel, plain: bool = False):
        self.plain = plain
        if plain:
            byte_of = {s: b for b, s in enumerate(byte_symbols())}
            end = model.suffix
            self.bytes = {
                i: bytes(byte_of[c] for c in s.removesuffix(end)) + b" " * (end != "" and s.endswith(end))
                for s, i in model.vocab.items()
            } | {i: s.encode() for s, i in model.added.items()}
        else:
            self.bytes = {i: b" " + s.encode() for i, s in model.strings.items()}
        self.reset()

    def reset(self) -> None:
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")
        self.begun = self.plain

    def feed(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.bytes.__getitem__, ids))
        if data and not self.begun:
            self.begun, data = True, data[1:]
        return self.utf8.decode(data)

    def finish(self) -> str:
        left = self.utf8.decode(b"", True)
        self.reset()
        return left


_ready: dict[str, tuple[Encoder, Decoder, list[str]]] = {}


def _codec(path: str) -> tuple[Encoder, Decoder, list[str]]:
    """Encoder, decoder and ids' decimal strings, once per worker process and file."""
    if path not in _ready:
        model = BpeModel(path)
        _ready[path] = Encoder(model), Decoder(model), list(map(str, range(max(model.strings) + 1)))
    return _ready[path]


def _digests(path: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder, decimal = _codec(path)
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for text in batch.column(1):
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for ids in encoder.encode(text.as_py()):
                    if ids:
                        of_ids.update((" " * (n > 0) + " ".join(map(decimal.__getitem__, ids))).encode())
                        of_text.update(decoder.feed(ids).encode())
                        n += len(ids)
                of_text.update(decoder.finish().encode())
                counts.append(n)
                id_digests.append(of_ids.hexdigest())
                text_digests.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return of


def report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the text decoded from them."""
    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _digests(tokenizer), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id and the array of its ids."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _, _ = _codec(tokenizer)
        for batch in batches:
            ids = [[i for part in encoder.encode(t.as_py()) for i in part] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    return rows.mapInArrow(of, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decoded(ids: DataFrame, tokenizer: str, plain: bool = False) -> DataFrame:
    """doc_id and the text of its ids."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(BpeModel(tokenizer), plain)
        for batch in batches:
            texts = [decoder.feed(x.as_py() or []) + decoder.finish() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(of, f"doc_id {ids.schema['doc_id'].dataType.simpleString()}, text string")
