"""Byte-level BPE against the tiktoken library."""

import hashlib
import random
from array import array
from collections import Counter

import public_tokenizers
import pytest
import regex
import tiktoken
from tokenizers import Regex, Tokenizer, normalizers, pre_tokenizers

from rxtrail.llm import bytebpe, letters
from rxtrail.llm.queries import RANKS, TOKENIZER
from rxtrail.llm.shared import documents

CODEC = bytebpe.codec(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=CODEC.ranks.rank, special_tokens={})
POINTS = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)


def ids_of(text):
    return [i for part in CODEC.encode(text) for i in part]


def naive(piece, rank):
    """Merges by searching all pairs."""
    parts = [bytes([b]) for b in piece]
    while found := [(rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in rank]:
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [rank[p] for p in parts]


def test_all_code_points():
    for i in range(0, len(POINTS), 5000):
        block = POINTS[i : i + 5000]
        for text in (block, "a".join(block), " ".join(block), "1".join(block), "!".join(block)):
            assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_random_texts(monkeypatch):
    pick = random.Random(11)
    alphabets = ["ab", "the 's'll\n\t ", "aé漢🙂0١ ", " \n", "x'S't!?", "\x85\xa0  aꟋ\U00010d40\U00018e00"]
    texts = ["".join(pick.choice(pick.choice(alphabets[k:])) for _ in range(pick.randrange(200))) for k in range(6) for _ in range(300)]
    texts += ["".join(pick.choice(POINTS) for _ in range(pick.randrange(60))) for _ in range(2000)]
    wanted = [LIBRARY.encode_ordinary(text) for text in texts]
    for stretch in (1 << 18, 5):
        monkeypatch.setattr(bytebpe, "STRETCH", stretch)
        for text, ids in zip(texts, wanted, strict=True):
            assert ids_of(text) == ids
            assert CODEC.decode(array("I", ids)) == text.encode()


def test_pieces_against_all_pairs():
    pick = random.Random(12)
    few = {bytes([b]): b for b in range(256)} | {w: 256 + i for i, w in enumerate([b"ab", b"ba", b"aa", b"abab", b"aab", b"bb", b"bbaa"])}
    for _ in range(2000):
        piece = bytes(pick.choice(b"aab") for _ in range(pick.randrange(1, 40)))
        assert bytebpe.encode_piece(piece, few) == ([few[piece]] if piece in few else naive(piece, few))


def test_long_pieces():
    for text in ("a" * 300_000, "é" * 70_000 + " " * 50_000 + "b", "ab " * 200_000, "\n" * 100_000):
        assert ids_of(text) == LIBRARY.encode_ordinary(text)


def test_tree_holds_leftmost_least():
    pick = random.Random(13)
    for n in (1, 2, 7, 64, 65):
        ranks = [pick.choice([None, 1, 2, 3]) for _ in range(n)]
        tree = bytebpe.PairTree(ranks)
        for _ in range(200):
            known = [(r, i) for i, r in enumerate(ranks) if r is not None]
            assert tree.least() == (min(known)[1] if known else -1)
            i = pick.randrange(n)
            ranks[i] = pick.choice([None, 0, 1, 2, 3])
            tree.set(i, ranks[i])


def test_letters_are_the_libraries():
    normal = Tokenizer.from_file(TOKENIZER).normalizer
    spaceless = regex.sub(r"\s", "", POINTS)
    for c in spaceless:
        assert letters.lowered(letters.composed(c)) == normal.normalize_str(c)
    compose, pick = normalizers.NFC(), random.Random(14)
    marks = [c for c in spaceless if letters.unicodedata.category(c)[0] == "M"]
    for _ in range(60_000):
        text = "".join(pick.choice([pick.choice(marks), pick.choice("aeoक\U00011935̖́ͅ"), pick.choice(spaceless)]) for _ in range(5))
        assert letters.composed(text) == compose.normalize_str(text)
    for kind in "LN":
        split = pre_tokenizers.Split(Regex(rf"\p{{{kind}}}"), "removed", invert=True)
        assert "".join(letters.parts(regex.compile(rf"\p{{{kind}}}"), POINTS)) == "".join(x for x, _ in split.pre_tokenize_str(POINTS))


@pytest.mark.parametrize("empty", [False, True])
def test_queries(spark, tmp_path, empty):
    made = [(1, "Hello world's end", "p", 1), (1, "Hello world's end", "p", 1), (2, None, None, 2), (3, "", "", 3), (None, " \n\n x", "p", 4)]
    schema = "doc_id long, text string, ids string, n_tokens int"
    spark.createDataFrame([] if empty else made, schema).write.parquet(f"{tmp_path}/documents.parquet")
    docs = documents(spark, str(tmp_path))
    found = Counter(tuple(r) for r in bytebpe.report(docs, RANKS, public_tokenizers.PATTERN).collect())
    digest = lambda data: hashlib.sha256(data).hexdigest()
    wanted = Counter()
    for i, text, *_ in [] if empty else made:
        ids = LIBRARY.encode_ordinary(text or "")
        wanted[i, len(ids), digest(" ".join(map(str, ids)).encode()), digest((text or "").encode())] += 1
    assert found == wanted
    ids = bytebpe.encoded(docs, RANKS, public_tokenizers.PATTERN)
    back = Counter((r.doc_id, bytes(r.bytes)) for r in bytebpe.decoded(ids, RANKS, public_tokenizers.PATTERN).collect())
    assert back == Counter((i, (t or "").encode()) for i, t, *_ in ([] if empty else made))
