"""Personal data by candidates and boosted trees.

High-recall generators propose overlapping spans: addresses with @ or "at", runs of digit
groups, dotted quads, hexadecimal groups, values after words such as token or password. Each
gets format features (length, digits, separators, entropy, checksums) and context features
(cue words and characters around it). Boosted trees score candidates, and a threshold per
kind, chosen on candidates kept out of the fit for a precision of 99 %, selects redactions.

Base matches of the four fixed patterns are always redacted; the trees add spans, which may
overlap base ones, and what any span covers is redacted.
There are no hand-made labels, so training labels are weak: base matches and quoted secrets
are positive, candidates that fail their checks are negative, what can't be told is left out
of the fit and only scored. A quarter of the texts, by hash, is held out. The fit uses at most
``SAMPLE_ROWS`` candidates of the others, an equal share for each kind and label, so that rare
kinds are met at any size of the corpus; thresholds come from all held-out candidates. Both count
candidates that are alike in span, context and label once. Scoring covers every document.

Defined results: where the texts outside the held-out quarter have no candidates of both labels,
there is nothing to fit and only base matches are found; a null text counts as empty and has no spans; positions are code points, end
exclusive; patterns run in time linear in the text. Spans are listed by kind, then start.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtrail.llm.shared import staging, text_or_empty
from rxtrail.sources.staging import Staging

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
SAMPLE_ROWS = 50_000
PRECISION = 0.99
#: Least scores of the bins that thresholds are taken from: log-odds in steps of 1/64.
SCORE_BINS = 1 / (1 + np.exp(-np.arange(-1024, 1024) / 64))
CONTEXT = 32
TREES, DEPTH, RATE, BINS = 40, 3, 0.3, 32

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_GROUPS = re.compile(r"[0-9]+(?:\.[0-9]+)*+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Generators beyond the base patterns.
_AT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(]at[\])] ?| at )[A-Za-z0-9-]++(?:(?: ?[\[(]dot[\])] ?| dot |\.)[A-Za-z]{2,}+)+"
)
_NUMBER = re.compile(r"\(?[0-9](?:[ ().\-/]{0,3}[0-9])++")
_SECRET = re.compile(
    r"(?i)\b(?:token|secret|password|passwd|pwd|api[_ -]?key|access[_ -]?key|key)\b\s{0,3}(?:=|:|is)\s{0,3}[\"']?([^\s\"']{6,})"
)
_HEX = re.compile(r"\b(?=[a-fA-F]*+[0-9])[0-9a-fA-F]{24,}+\b")

CUES = {
    "email": re.compile(r"(?i)e-?mail|contact|write to|mailto"),
    "ip": re.compile(r"(?i)\bip\b|host|server|address|login from"),
    "card": re.compile(r"(?i)card|visa|master|amex|credit|payment|cc\b"),
    "phone": re.compile(r"(?i)phone|\btel\b|call|mobile|fax|whatsapp"),
    "secret": re.compile(r"(?i)token|secret|passw|pwd|key"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What the e-mail pattern finds, stepping from @ to @ instead of trying every character."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(last, at + 1))


def _quads(text: str) -> Iterator[tuple[int, int]]:
    """Each four dotted groups of digits in turn, as the pattern takes them."""
    for chain in _GROUPS.finditer(text):
        if chain.group().count(".") >= 3:
            groups = list(_GROUP.finditer(text, chain.start(), chain.end()))
            for i in range(0, len(groups) - 3, 4):
                yield groups[i].start(), groups[i + 3].end()


_GROUP = re.compile(r"[0-9]+")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns that pass their checks, by kind, then start."""
    spans = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for a, b in _quads(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in text[a:b].split(".")):
                spans.append(("ip", a, b))
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_digits(m.group())) <= 15:
                    spans.append(("phone", *m.span()))
    return spans


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, int]]:
    """Proposed spans: kind, start, end, weak label (1, 0 or -1 for unknown)."""
    found = {span: 1 for span in base}

    def propose(kind: str, start: int, end: int, label: int) -> None:
        found.setdefault((kind, start, end), label)

    if _DIGIT.search(text):
        for a, b in _quads(text):
            propose("ip", a, b, 0)
        for m in _CARD.finditer(text):
            n = len(_digits(m.group()))
            if n >= 9:
                propose("card", *m.span(), 0)
        for m in _NUMBER.finditer(text):
            n = len(_digits(m.group()))
            if n >= 7:
                propose("phone", *m.span(), -1 if 9 <= n <= 12 else 0)
    if " at " in text or "at)" in text or "at]" in text:
        for m in _AT.finditer(text):
            propose("email", *m.span(), -1 if "dot" in m.group() or "(" in m.group() or "[" in m.group() else 0)
    for m in _SECRET.finditer(text):
        a, b = m.span(1)
        quoted = text[a - 1] in "\"'"
        propose("secret", a, b, 1 if quoted and b - a >= 16 and _entropy(text[a:b]) > 3 else 0 if _entropy(text[a:b]) < 2.6 else -1)
    if _DIGIT.search(text):
        for m in _HEX.finditer(text):
            propose("secret", *m.span(), -1)
    return [(*span, label) for span, label in found.items()]


def _entropy(text: str) -> float:
    _, counts = np.unique(list(text), return_counts=True)
    share = counts / counts.sum()
    return float(-(share * np.log2(share)).sum())


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span."""
    span, before, after = text[start:end], text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    digits = _digits(span)
    letters = sum(c.isalpha() for c in span)
    parts = [p for p in re.split(r"[^0-9]+", span) if p]
    return [
        float(KINDS.index(kind)),
        float(len(span)),
        float(len(digits)),
        letters / len(span),
        float(len(set(span) - set("0123456789") - {c for c in span if c.isalpha()})),
        float(len(parts)),
        float(max(map(len, parts), default=0)),
        _entropy(span),
        float(13 <= len(digits) <= 19 and luhn(digits)),
        float(len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)),
        float(9 <= len(digits) <= 15),
        float(bool(re.search(r"\.[A-Za-z]{2,}$|dot", span))),
        float(bool(CUES[kind].search(before))),
        float(any(c.search(before) for k, c in CUES.items() if k != kind)),
        float(bool(CUES[kind].search(after))),
        float(before[-1:].isalnum()),
        float(after[:1].isalnum()),
        float(before[-1:] in tuple("\"'=:([")),
        float(bool(re.search(r"[$€£%]\s?$", before)) or after[:1] in ("%", "€", "$")),
        sum(c in "0123456789" for c in before + after) / max(1, len(before + after)),
    ]


@dataclass
class Trees:
    """Boosted trees on binned features, logistic loss, and a threshold per kind."""

    edges: list[np.ndarray] = field(default_factory=list)
    trees: list[list[tuple[int, int, np.ndarray]]] = field(default_factory=list)
    start: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        b, total = self.binned(x), np.full(len(x), self.start)
        for levels in self.trees:
            total += self._leaf(b, levels)
        return 1 / (1 + np.exp(-total))

    @staticmethod
    def _leaf(b: np.ndarray, levels: list[tuple[int, int, np.ndarray]]) -> np.ndarray:
        node = np.zeros(len(b), np.int64)
        for j, cut, _ in levels:
            node = 2 * node + (b[:, j] > cut)
        return levels[-1][2][node]

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        """Symmetric trees: one split per level, the one that gains most over all nodes."""
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(x.shape[1])]
        b, mean = self.binned(x), np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(mean / (1 - mean)))
        total = np.full(len(y), self.start)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-total))
            g, h = y - p, p * (1 - p)
            node, levels = np.zeros(len(y), np.int64), []
            for depth in range(DEPTH):
                j, cut = self._split(b, g, h, node, 1 << depth)
                node = 2 * node + (b[:, j] > cut)
                levels.append((j, cut, np.empty(0)))
            sums = [np.bincount(node, w, minlength=1 << DEPTH) for w in (g, h)]
            leaf = RATE * sums[0] / (sums[1] + 1.0)
            levels[-1] = (*levels[-1][:2], leaf)
            self.trees.append(levels)
            total += leaf[node]
        return self

    def _split(self, b: np.ndarray, g: np.ndarray, h: np.ndarray, node: np.ndarray, nodes: int) -> tuple[int, int]:
        best = (-1.0, 0, 0)
        for j, edges in enumerate(self.edges):
            width = len(edges) + 1
            at = node * width + b[:, j]
            sums = [np.bincount(at, w, minlength=nodes * width).reshape(nodes, width).cumsum(axis=1) for w in (g, h)]
            left_g, left_h = sums[0][:, :-1], sums[1][:, :-1]
            right_g, right_h = sums[0][:, -1:] - left_g, sums[1][:, -1:] - left_h
            gain = (left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1)).sum(axis=0)
            if len(gain) and gain.max() > best[0]:
                best = (float(gain.max()), j, int(gain.argmax()))
        return best[1], best[2]

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Thresholds from candidates at hand."""
        kinds, bins = x[:, 0].astype(int).tolist(), score_bins(self.scores(x)).tolist()
        self.set_thresholds(Counter(zip(kinds, bins, y.astype(int).tolist(), strict=True)))

    def set_thresholds(self, counts: dict[tuple[int, int, int], int]) -> None:
        """Per kind, the least score from which on ``PRECISION`` of held-out candidates are right.

        Counts are by number of the kind, score bin and label; a bin is taken whole or not at all.
        """
        for i, kind in enumerate(KINDS):
            right, every, self.thresholds[kind] = 0, 0, 2.0
            for b in sorted({b for k, b, _ in counts if k == i}, reverse=True):
                right += counts.get((i, b, 1), 0)
                every += counts.get((i, b, 0), 0) + counts.get((i, b, 1), 0)
                if right >= PRECISION * every:
                    self.thresholds[kind] = max(0.5, float(SCORE_BINS[b]))


def score_bins(scores: np.ndarray) -> np.ndarray:
    """The last of ``SCORE_BINS`` that each score reaches, else the first."""
    return np.maximum(np.searchsorted(SCORE_BINS, scores, "right") - 1, 0)


def candidate_hash(text: str, kind: str, start: int, end: int, label: int) -> int:
    """64 bits of all that features and label depend on, so that copies are one candidate."""
    parts = kind, str(label), text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT]
    return xxhash.xxh64_intdigest("\0".join(f"{len(p)}:{p}" for p in parts).encode())


def _labelled(batch: pa.RecordBatch) -> Iterator[tuple[int, int, int, str, int, int]]:
    """Hash, number of the kind, label, text, start and end of what has a label."""
    for text in batch.column(0):
        text = text.as_py()
        for kind, start, end, label in candidates(text, base_spans(text)):
            if label >= 0:
                yield candidate_hash(text, kind, start, end, label), KINDS.index(kind), label, text, start, end


def _lowest(most: int):
    """Per task, kind and label, the ``most`` different candidates of the least hashes."""

    def pruned(some: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
        return {h: some[h] for h in sorted(some)[:most]}

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], dict[int, np.ndarray]] = {}
        bound: dict[tuple[int, int], int] = {}
        for batch in batches:
            for h, kind, label, text, start, end in _labelled(batch):
                some = held.setdefault((kind, label), {})
                if h in some or h > bound.get((kind, label), h):
                    continue
                some[h] = np.array(features(text, KINDS[kind], start, end))
                if len(some) >= 2 * most:
                    held[kind, label] = some = pruned(some)
                    bound[kind, label] = max(some)
        for (kind, label), some in held.items():
            hashes = list(pruned(some))
            for i in range(0, len(hashes), 1000):
                part = hashes[i : i + 1000]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([kind] * n, pa.int32()), pa.array([label] * n, pa.int32()),
                     pa.array([64 - h.bit_length() for h in part], pa.int32()),
                     pa.array(np.array(part, np.uint64).view(np.int64)),
                     pa.array([some[h] for h in part], pa.list_(pa.float64()))],
                    ["kind", "label", "level", "h", "x"],
                )

    return of


def draw(texts: DataFrame, store: Staging, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``most`` different candidates of each kind and label."""
    rows = store.write(texts.mapInArrow(_lowest(most), "kind int, label int, level int, h long, x array<double>"), "labelled")
    # A level holds half as many hashes as the one before, so the highest ones that hold enough are few.
    counts = rows.select("kind", "label", "level", "h").distinct().groupBy("kind", "label", "level").count().collect()
    taken = F.lit(False)
    for kind, label in {(r.kind, r.label) for r in counts}:
        size = {r.level: r["count"] for r in counts if (r.kind, r.label) == (kind, label)}
        least = max((v for v in size if sum(n for w, n in size.items() if w >= v) >= most), default=0)
        taken |= (F.col("kind") == kind) & (F.col("label") == label) & (F.col("level") >= least)
    data = rows.where(taken).dropDuplicates(["kind", "label", "h"]).toPandas()
    # By hash as an unsigned number.
    data = data.iloc[np.argsort(data["h"].to_numpy(np.int64).view(np.uint64), kind="stable")]
    data = data.groupby(["kind", "label"], sort=True).head(most)
    x = np.stack(data["x"].to_numpy()) if len(data) else np.empty((0, 0))
    return x, data["label"].to_numpy(float)


def held_out_counts(texts: DataFrame, trees: Trees) -> dict[tuple[int, int, int], int]:
    """How many different candidates of all texts have each kind, score bin and label."""
    shared = texts.sparkSession.sparkContext.broadcast(trees)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {c[0]: c[1:] for c in _labelled(batch)}
            x = np.array([features(text, KINDS[kind], a, b) for kind, _, text, a, b in found.values()])
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[0] for c in found.values()], pa.int32()),
                 pa.array(score_bins(shared.value.scores(x)).astype(np.int32)),
                 pa.array([c[1] for c in found.values()], pa.int32()),
                 pa.array(np.array(list(found), np.uint64).view(np.int64))],
                ["kind", "bin", "label", "h"],
            )

    scored = texts.mapInArrow(of, "kind int, bin int, label int, h long").distinct()
    return {(r.kind, r.bin, r.label): r["count"] for r in scored.groupBy("kind", "bin", "label").count().collect()}


def fit(docs: DataFrame) -> Trees:
    """Trees from a bounded draw of weakly labelled candidates, thresholds from all held-out ones."""
    texts = docs.select(text_or_empty("text").alias("text"))
    held = F.pmod(F.xxhash64("text", F.lit("pii part")), F.lit(4)) == 0
    trees, most = Trees(), SAMPLE_ROWS // (2 * len(KINDS))
    with staging(docs.sparkSession) as store:
        x, y = draw(texts.where(~held), store, most)
    if len(set(y)) < 2:
        return trees
    trees.fit(x, y)
    trees.set_thresholds(held_out_counts(texts.where(held), trees))
    return trees


def select(text: str, trees: Trees) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: base ones with the best-scored others.

    The others overlap each other nowhere, and each holds a character that no base span does; a
    secret around a card number is one such.
    """
    base = base_spans(text)
    fixed = set(base)
    others = [c for c in candidates(text, base) if c[:3] not in fixed] if trees.trees else []
    if not others:
        return base, base
    scores = trees.scores(np.array([features(text, *c[:3]) for c in others]))
    good = [(-s, c[:3]) for s, c in zip(scores.tolist(), others, strict=True) if s >= trees.thresholds[c[0]]]
    # A mark per character, so that many spans cost no more each.
    covered, taken = bytearray(len(text)), bytearray(len(text))
    for _, a, b in base:
        covered[a:b] = b"\1" * (b - a)
    added = []
    for _, (kind, a, b) in sorted(good):
        if 0 in covered[a:b] and 1 not in taken[a:b]:
            taken[a:b] = b"\1" * (b - a)
            added.append((kind, a, b))
    return base, sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def found(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, counts and digest of base spans, all spans, and the text with spans replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, texts = [], [], [], []
            for text in batch.column(1):
                text = text.as_py()
                base, every = select(text, shared.value)
                counts.append([sum(s[0] == k for s in base) for k in BASE_KINDS])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(every))
                texts.append(redacted(text, every))
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(BASE_KINDS))]
            columns += [pa.array(c, pa.string()) for c in (digests, spans, texts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], ["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "redacted"]
            )

    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in BASE_KINDS)
    return rows.mapInArrow(of, f"doc_id {kind}, {counts}, base_sha256 string, spans string, redacted string")


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with spans replaced by their kind; overlapping ones as one, by the longest's."""
    joined: list[list] = []  # kind and length of the longest, start, end
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if joined and start < joined[-1][3]:
            last = joined[-1]
            last[:2] = max([kind, end - start], last[:2], key=lambda k: k[1])
            last[3] = max(last[3], end)
        else:
            joined.append([kind, end - start, start, end])
    out, done = [], 0
    for kind, _, start, end in joined:
        out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]])


def report(docs: DataFrame) -> DataFrame:
    return found(docs, fit(docs)).drop("redacted")
