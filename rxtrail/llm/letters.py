"""Letters, numbers and normal forms as the tokenizer libraries know them.

The libraries count as letters and numbers what the Unicode standard does in version 16, lower
the case of some letters that came later still, and compose characters by a far older version:
marks that are younger neither move nor compose. Python's tables lie between, and those of the
pattern module are the newest, so what differs is put right here, by fixed values.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import groupby

import regex


def _of(ranges: str) -> set[int]:
    bounds = [[int(x, 16) for x in part.split("-")] for part in ranges.split()]
    return {code for bound in bounds for code in range(bound[0], bound[-1] + 1)}


# Letters and numbers that Unicode 16 added to 15.1.
LATER_LETTERS = _of(
    "1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389 1138b 1138e "
    "11390-113b5 113b7 113d1 113d3 11bc0-11be0 13460-143fa 16100-1611d 16d40-16d6c 18cff 1e5d0-1e5ed 1e5f0"
)
LATER_NUMBERS = _of("10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa")
# Marks, and parts of one letter, that the libraries neither reorder nor compose.
UNMOVED = _of(
    "7fd 898-89f 8ca-8d3 9fe c3c d3b-d3c eba 1715 1abf-1ace 1df6-1dfa a82c 10d24-10d27 10eab-10eac 10efd-10eff "
    "10f46-10f50 10f82-10f85 11070 1133b 1145e 11839-1183a 11930 11938 1193d-1193e 11943 119e0 11a34 11a47 11a99 11d42 "
    "11d44-11d45 11d97 11f41-11f42 16ff0-16ff1 1e08f 1e130-1e136 1e2ae 1e2ec-1e2ef 1e4ec-1e4ef"
)
# Lower case of capital letters that Python does not know.
LATER_LOWER = {0xA7CB: 0x264, 0xA7DC: 0x19B}
LATER_LOWER |= {code: code + 1 for code in (0x1C89, 0xA7CC, 0xA7CE, 0xA7D2, 0xA7D4, 0xA7DA)}
LATER_LOWER |= {code: code + 0x20 for code in range(0x10D50, 0x10D66)}
LATER_LOWER |= {code: code + 0x1B for code in range(0x16EA0, 0x16EB9)}


class Characters:
    """A set of characters, and a quick way to see whether a text has any of them."""

    def __init__(self, codes: Iterable[int]):
        self.codes = frozenset(codes)
        self.characters = frozenset(map(chr, self.codes))
        least = min(self.codes, default=sys.maxunicode)
        self._from_least = re.compile(f"[\\U{least:08x}-\\U0010ffff]+")

    def any_in(self, text: str) -> bool:
        # Most texts have hardly a character from the least one on, and one range is a quick test.
        if not self._from_least.search(text):
            return False
        return any(not self.characters.isdisjoint(part) for part in self._from_least.findall(text))


_unmoved, _later_lower = Characters(UNMOVED), Characters(LATER_LOWER)
_may_differ = re.compile(f"[\\U{min(UNMOVED | set(LATER_LOWER)):08x}-\\U0010ffff]").search


def composed(text: str) -> str:
    """Normal form C of the libraries' version."""
    if text.isascii():
        return text
    if not _unmoved.any_in(text):
        return unicodedata.normalize("NFC", text)
    groups = groupby(text, _unmoved.characters.__contains__)
    return "".join("".join(g) if alone else unicodedata.normalize("NFC", "".join(g)) for alone, g in groups)


def lowered(text: str) -> str:
    """Lower case character by character, so without the final form of sigma."""
    if text.isascii():
        return text.lower()
    if _later_lower.any_in(text):
        text = text.translate(LATER_LOWER)
    return text.replace("Σ", "σ").lower()


def normal(text: str) -> str:
    """Composed, then in lower case."""
    if text.isascii():
        return text.lower()
    if not _may_differ(text):
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    return lowered(composed(text))


@cache
def _misread() -> tuple[Characters, dict[int, str]]:
    """Characters of another class to the pattern module than to the libraries, and for each a
    character of the class it should have."""
    points = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    whole = "".join(points)
    instead: dict[int, str] = {}
    for kind, stand_in, later in (("L", "α", LATER_LETTERS), ("N", "0", LATER_NUMBERS)):
        read = set(regex.findall(rf"\p{{{kind}}}", whole))
        meant = {c for c in points if unicodedata.category(c)[0] == kind} | {chr(c) for c in later}
        instead |= {ord(c): stand_in for c in meant - read}
        instead |= {ord(c): "#" for c in read - meant if ord(c) not in instead}
    return Characters(instead), instead


def parts(pattern: regex.Pattern, text: str) -> Iterator[str] | list[str]:
    """What the pattern finds in the text, by the libraries' letters and numbers."""
    if not text.isascii():
        odd, instead = _misread()
        if odd.any_in(text):
            return [text[m.start() : m.end()] for m in pattern.finditer(text.translate(instead))]
    return pattern.findall(text)
