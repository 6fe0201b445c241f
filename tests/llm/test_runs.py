"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from rxtrail.llm import runs
from rxtrail.llm.shared import documents, python_words


def brute(codes, least=12):
    n, found = len(codes), {}
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if codes[i] != codes[i - q]:
                i += 1
                continue
            first = i
            while i < n and codes[i] == codes[i - q]:
                i += 1
            if i - first + q >= max(least, 2 * q):
                found.setdefault((first - q, i), q)
    return sorted((a, z - a, q) for (a, z), q in found.items())


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def sequences():
    pick = random.Random(21)
    for letters in (1, 2, 3, 5):
        for _ in range(150):
            yield [pick.randrange(letters) for _ in range(pick.randrange(90))]
    for _ in range(250):  # periodic parts, some broken
        made = []
        while len(made) < 150:
            unit = [pick.randrange(pick.choice([2, 9])) for _ in range(pick.randrange(1, 30))]
            made += (unit * pick.randrange(1, 6))[: pick.randrange(1, 120)]
            if pick.random() < 0.4 and made:
                made[pick.randrange(len(made))] = 99
        yield made
    yield list(fibonacci(400))
    yield [bin(i).count("1") % 2 for i in range(512)]  # no cubes, many equal running sums
    yield [0] * 700
    yield [1, *[0] * 60, 2, *[0] * 60, 3, *[0] * 60, 1, *[0] * 60, 2, *[0] * 61]
    yield list(range(50)) * 7
    yield []


def codes_of(sequence):
    code = {}
    return np.array([code.setdefault(x, len(code)) for x in sequence], np.int64)


@pytest.mark.parametrize("appended", [1 << 16, 64, 7, 1])
def test_runs_against_brute_force(appended):
    for i, sequence in enumerate(sequences()):
        if appended == 1 and i % 5 and len(sequence) < 200:
            continue
        codes = codes_of(sequence)
        assert runs.runs_of(codes, appended=appended) == brute(codes.tolist())


def test_every_period_and_place():
    for q in range(1, 40):
        for start in range(0, 20):
            for length in (max(12, 2 * q) - 1, max(12, 2 * q), 2 * q + 13):
                unit = list(range(100, 100 + q))
                sequence = [*range(1000, 1000 + start), *(unit * (length // q + 1))[:length], *range(2000, 2009)]
                wanted = [(start, length, q)] if length >= max(12, 2 * q) else []
                assert runs.runs_of(codes_of(sequence)) == wanted == brute(sequence)


def test_long_text():
    pick = np.random.default_rng(22)
    codes = pick.integers(0, 1000, 300_000)
    codes[50_000:250_000] = codes[50_000 + np.arange(200_000) % 60_001]
    found = runs.runs_of(codes)
    assert [r for r in found if r[2] == 60_001] == [(50_000, 200_000, 60_001)]
    assert runs.runs_of(np.zeros(1_000_000, np.int64)) == [(0, 1_000_000, 1)]


def test_known_before_the_end():
    """Nothing waits for words to come: an open run is known from the words read."""
    codes = codes_of([5, 6, *[1, 2, 3] * 4])
    catcher = runs.SquareCatcher()
    catcher.append(codes)
    assert (2, 14, 3) in catcher.squares and not catcher.runs
    catcher.append(codes_of([0]) + 9)
    assert catcher.runs == {(2, 14): 3} and not catcher.squares


def planted(doc_id, text):
    w = python_words(text)
    if doc_id is None:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, text)
    found = brute(w)
    drop = {i for s, n, p in found for i in range(s + p, s + n)}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * top[1] // top[2] if found else None
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), *top, milli, digest(lines), digest(" ".join(x for i, x in enumerate(w) if i not in drop)))


def test_query(spark, tmp_path):
    pick = random.Random(23)
    made = [(i, " ".join(pick.choice("abc") if i % 2 else f"w{pick.randrange(50)}" for _ in range(pick.randrange(1, 120)))) for i in range(200)]
    made += [made[3], (None, "x " * 30), (None, None), (900, None), (901, ""), (902, " \n\t"), (903, "é\x85 " * 20 + "e"), (904, "a b\nc\td " * 9)]
    rows = [(i, t, "extra", 1, [2]) for i, t in made]
    spark.createDataFrame(rows, "doc_id long, text string, collapsed string, n_words int, runs array<int>").write.parquet(f"{tmp_path}/documents.parquet")
    found = runs.report(runs.with_planted_runs(documents(spark, str(tmp_path))))
    assert Counter(tuple(r) for r in found.collect()) == Counter(expected(i, t) for i, t in made)
    assert runs.report(runs.with_planted_runs(documents(spark, str(tmp_path)).where("false"))).count() == 0
