"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

A run is a stretch of words with smallest period q, at least ``max(12, 2 q)`` words long, that
can be extended on neither side with that period. Words are appended bit by bit, and at no time
is anything looked at that has not been appended yet:

* When the last word of an aligned block of 2^k words is appended, a catcher takes up the block.
  It serves the squares whose left half holds the block and whose period lies in [2^(k+1),
  2^(k+2)); any left half that long holds an aligned block of that size. Periods 1 to 3 are
  served by blocks of four, since a run of twelve with such a period has enough words for one.
* Each appended word ends one suffix of 2^k words per size, which is compared with the two
  catchers of that size whose periods fit. The comparison is that of two differences of one
  running sum, word codes times powers of an odd number, so it needs nothing but the sum.
* A suffix that agrees with a catcher's block is compared word by word, then extended to the left
  once and to the right as words are appended. The stretch, both copies together, is a square as
  soon as it is as long as two periods; further squares of the period that overlap merge with it
  into the run. It closes at the first word that differs.

A stretch whose period is a multiple of that of a square covering it is that run again and is not
followed. Of equal stretches the smallest period counts, so every run has its smallest period. A
text of n words costs n log n simple steps on arrays, and memory is a few numbers per word.

Each text is worked on by itself in the task that holds its row; nothing is shuffled. Defined
results: a null or empty text has no runs; words are compared as they are; rows with one doc_id
are rows of their own; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.llm.shared import python_words, text_or_empty, words

LEAST_LENGTH = 12
#: Words appended at once. Results are the same for any number.
APPENDED = 1 << 16
BASE = np.uint64(0x9E3779B97F4A7C15)
RUN = "struct<start:long,length:long,period:long>"


def _mixed(codes: np.ndarray) -> np.ndarray:
    """Numbers to numbers that look random, one to one."""
    x = codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SquareCatcher:
    """Finds the runs of a sequence of word codes that is appended to."""

    def __init__(self, least_length: int = LEAST_LENGTH):
        self.least_length = least_length
        self.n = 0
        self.words = np.zeros(256, np.int64)
        self.power = np.zeros(256, np.uint64)  # of the base, one per word
        self.sums = np.zeros(257, np.uint64)  # of the codes times powers of all words before
        self.following: dict[int, tuple[int, int]] = {}  # open stretches by period: start, end so far
        self.squares: list[tuple[int, int, int]] = []  # those among them that hold a square
        self.runs: dict[tuple[int, int], int] = {}

    def append(self, codes: np.ndarray) -> None:
        """Read further words."""
        old, self.n = self.n, self.n + len(codes)
        if self.n > len(self.words):
            room = max(2 * len(self.words), self.n)
            self.words, self.power = np.resize(self.words, room), np.resize(self.power, room)
            self.sums = np.resize(self.sums, room + 1)
        self.words[old : self.n] = codes
        self.power[old : self.n] = BASE
        if old:
            self.power[old : old + 1] = self.power[old - 1 : old] * BASE
        np.multiply.accumulate(self.power[old : self.n], out=self.power[old : self.n])
        self.sums[old + 1 : self.n + 1] = _mixed(codes) * self.power[old : self.n]
        np.add.accumulate(self.sums[old : self.n + 1], out=self.sums[old : self.n + 1])
        self._advance(old)
        self._follow(*self._caught(old))

    def finish(self) -> list[tuple[int, int, int]]:
        """All runs as start, length and period, by start and period."""
        for period, (start, end) in self.following.items():
            self._close(start, end, period)
        self.following, self.squares = {}, []
        return sorted((start, end - start, period) for (start, end), period in self.runs.items())

    def _caught(self, old: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Suffixes that agree with a catcher's block: end, period and block, by end and period."""
        ends, periods, blocks = [], [], []

        def compare(block: np.ndarray, place: np.ndarray, size: int) -> None:
            period = place - block
            mine = self.sums[place + size] - self.sums[place]
            kept = (self.sums[block + size] - self.sums[block]) * self.power[period - 1]
            hit = np.flatnonzero(mine == kept)
            ends.append(place[hit] + size)
            periods.append(period[hit])
            blocks.append(block[hit])

        for period in (1, 2, 3):
            first = max(0, old - period - 3)
            block = np.arange(-(-first // 4) * 4, self.n - period - 3, 4)
            compare(block, block + period, 4)
        size = 2
        while 3 * size <= self.n:
            place = np.arange(max(2 * size, old - size + 1), self.n - size + 1)
            recent = (place // size - 2) * size
            compare(recent, place, size)
            older = place >= 3 * size
            compare(recent[older] - size, place[older], size)
            size *= 2
        ends, periods, blocks = (np.concatenate(x) for x in (ends, periods, blocks))
        order = np.lexsort((periods, ends))
        return ends[order], periods[order], blocks[order]

    def _follow(self, ends: np.ndarray, periods: np.ndarray, blocks: np.ndarray) -> None:
        """Follow each caught stretch that no known one covers."""
        wanted = np.ones(len(ends), bool)
        for start, end, period in self.squares:
            self._leave_out(wanted, ends, periods, blocks, 0, start, end, period)
        i, known = 0, self.following
        while i < len(ends):
            if not wanted[i]:
                later = wanted[i:].argmax()
                if not wanted[i + later]:
                    break
                i += int(later)
            at, period, block = int(ends[i]), int(periods[i]), int(blocks[i])
            i += 1
            if period in known and known[period][1] >= at:
                continue
            start = self._left(block, period)
            end = self._right(block + period, period)
            if end < at:
                continue  # equal sums of different words
            known[period] = (start, end)
            if end - start >= 2 * period:
                self._leave_out(wanted, ends, periods, blocks, i, start, end, period)
                self.squares.append((start, end, period))
            if end < self.n:
                self._close(start, end, period)
        self._forget()

    def _leave_out(self, wanted, ends, periods, blocks, first: int, start: int, end: int, period: int) -> None:
        """No need to follow multiples of a period within its run."""
        last = int(np.searchsorted(ends, end, "right"))
        if last > first:
            part = slice(first, last)
            wanted[part] &= ~((blocks[part] >= start) & (periods[part] % period == 0))

    def _advance(self, old: int) -> None:
        """Compare the words appended with those one period before, for all open stretches."""
        squares = []
        for period, (start, _) in list(self.following.items()):
            end = self._right(old, period)
            self.following[period] = (start, end)
            if end - start >= 2 * period:
                squares.append((start, end, period))
            if end < self.n:
                self._close(start, end, period)
        self.squares = squares

    def _forget(self) -> None:
        """Keep open stretches only."""
        self.following = {p: s for p, s in self.following.items() if s[1] == self.n}
        self.squares = [s for s in self.squares if s[1] == self.n]

    def _right(self, place: int, period: int) -> int:
        """The first place from here on whose word differs from the one a period before."""
        size = 16
        while place < self.n:
            upto = min(place + size, self.n)
            differs = self.words[place:upto] != self.words[place - period : upto - period]
            first = int(differs.argmax())
            if differs[first]:
                return place + first
            place, size = upto, 4 * size
        return self.n

    def _left(self, place: int, period: int) -> int:
        """The first place up to here from which on words equal those a period later."""
        size = 16
        while place > 0:
            least = max(0, place - size)
            differs = self.words[least:place] != self.words[least + period : place + period]
            last = int(differs[::-1].argmax())
            if differs[len(differs) - 1 - last]:
                return place - last
            place, size = least, 4 * size
        return 0

    def _close(self, start: int, end: int, period: int) -> None:
        if end - start >= max(self.least_length, 2 * period):
            self.runs[start, end] = min(period, self.runs.get((start, end), period))


def runs_of(codes: np.ndarray, least_length: int = LEAST_LENGTH, appended: int = APPENDED) -> list[tuple[int, int, int]]:
    """All runs of a sequence of word codes: start, length, period."""
    catcher = SquareCatcher(least_length)
    for i in range(0, len(codes), appended):
        catcher.append(codes[i : i + appended])
    return catcher.finish()


def without_repeats(text_words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return text_words
    change = np.zeros(len(text_words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [text_words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, runs, collapsed = [], [], []
        for text in batch.column(1):
            text_words = python_words(text.as_py())
            code: dict[str, int] = {}
            codes = np.fromiter((code.setdefault(w, len(code)) for w in text_words), np.int64, len(text_words))
            found = runs_of(codes) if len(code) < len(codes) else []
            counts.append(len(text_words))
            runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
            collapsed.append(" ".join(without_repeats(text_words, found)))
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, kind), pa.array(collapsed, pa.string())],
            ["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Per document: n_words, its runs, and its words without the repeats, joined by blanks."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    return rows.mapInArrow(_found, f"doc_id {kind}, n_words long, runs array<{RUN}>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The query's documents: of those whose id has a hash divisible by 10, the end is made periodic."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def planted(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        place = F.sequence(F.lit(0).cast("long"), n - 1)
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        return F.array_join(F.transform(place, lambda i: F.get(w, source(i).cast("int"))), " ")

    array = words(text_or_empty("text"))
    made = F.transform(F.array(array), lambda w: F.when(F.size(w) > 0, planted(w)).otherwise(""))[0]
    text = F.when(h % 10 == 0, made).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Per document: the number of runs, the longest one, digests of all runs and of what is left."""
    found = periodic_runs(docs)
    # The longest run, of equal ones the first by start and period, as the least of (-length, ...).
    longest = F.array_min(
        F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p")))
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("top"), lines.alias("lines"), "collapsed").select(
        "doc_id",
        "n_runs",
        F.col("top.s").alias("start"),
        (-F.col("top.l")).alias("length"),
        F.col("top.p").alias("period"),
        F.floor(F.lit(1000) * -F.col("top.l") / F.col("top.p")).cast("long").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
