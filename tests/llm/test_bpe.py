"""The transducer against the tokenizers library: all code points, any cut, constant memory."""

import random

import pytest
from tokenizers import Tokenizer

from rxtrail.llm import bpe
from rxtrail.llm.queries import TOKENIZER

LIBRARY = Tokenizer.from_file(TOKENIZER)
MODEL = bpe.BpeModel(TOKENIZER)
POINTS = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)


def ids_of(text, encoder=None):
    return [i for piece in (encoder or bpe.Encoder(MODEL)).encode(text) for i in piece]


def library(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_all_code_points():
    encoder = bpe.Encoder(MODEL)
    for i in range(0, len(POINTS), 4000):
        block = POINTS[i : i + 4000]
        for text in (" ".join(block), "a".join(block), block):
            assert ids_of(text, encoder) == library(text)


@pytest.mark.parametrize("stretch", [1 << 16, 1, 7])
def test_random_texts(monkeypatch, stretch):
    monkeypatch.setattr(bpe, "STRETCH", stretch)
    monkeypatch.setattr(bpe, "LONGEST_KEY", 256 if stretch > 7 else 0)
    pick = random.Random(17)
    alphabets = ["ab", "the 's'll're'x", "aé漢🙂0١ ", " \n", "x'S't!?''", "é̖iͅ 각", "ᲉꟋ\U00010d50\U00018e00࢘a", "ΣİßÉ"]
    texts = ["".join(pick.choice(pick.choice(alphabets[k:])) for _ in range(pick.randrange(160))) for k in range(8) for _ in range(400)]
    texts += ["".join(pick.choice(POINTS) for _ in range(pick.randrange(40))) for _ in range(2500)]
    texts += ["x" * 9 + "<|endoftext|>" + "'" * 9 + "s<|startoftext|", "", " ", "'", "a'", "a're" * 9, "12'll3"]
    for text in texts:
        assert ids_of(text) == library(text)


def test_memory_is_a_stretch_and_the_buffer(monkeypatch):
    most, seen = [0], [0]
    feed, normalise = bpe.Transducer.feed, bpe.BpeModel.normalise

    def watched(self, data):
        for token in feed(self, data):
            most[0] = max(most[0], len(self.held))
            yield token
        most[0] = max(most[0], len(self.held))

    def measured(self, text):
        seen[0] = max(seen[0], len(text))
        return normalise(self, text)

    monkeypatch.setattr(bpe.Transducer, "feed", watched)
    monkeypatch.setattr(bpe.BpeModel, "normalise", measured)
    for text in ("abcdefgh" * 60_000, "é" * 200_000, "!" * 300_000, "7" * 150_000, "ab c" * 100_000):
        pieces = list(bpe.Encoder(MODEL).encode(text))
        assert [i for piece in pieces for i in piece] == library(text)
        assert max(map(len, pieces)) <= 2 * bpe.STRETCH
    assert most[0] <= 2 * bpe.Transducer(MODEL).size and seen[0] <= bpe.STRETCH + 1
