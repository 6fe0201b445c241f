"""Toxic passages as maximal scoring segments over token log-odds.

* Tokens are words, lower-cased and freed of marks at their ends. A word's features are the
  word and its first 3 to 8 characters, told apart by a 64-bit hash; the model holds only
  features with positive log-odds, some hundreds here. A token has the log-odds of its best
  feature.
* Log-odds of a feature between toxic and clean training documents carry a Dirichlet prior in
  proportion to its count in the whole corpus, and are shrunk by three times their deviation,
  so a feature seen by chance scores nothing. Tokens with positive log-odds are the marked ones;
  in a passage they make up ``SHARE`` of the tokens, each in proportion to its excess in toxic
  documents. A token scores the logarithm of its share in a passage over its share in the
  corpus: slightly negative for most, so chance segments stay short.
* A linear scan (Ruzzo and Tompa) finds all maximal scoring segments of a text.
* Extreme-value statistics make lengths comparable: with score S in a text of n tokens,
  E = K n exp(-S) segments as good are due to chance (scores being logarithms of ratios of
  two distributions, the exponent's rate is 1). K follows from the mean of the best segments
  of clean training documents. A segment with E below ``SIGNIFICANT`` is a passage;
  a document's statistic is the sum of -log E over its passages, and logistic calibration on
  training rows kept out of the counts turns it into a probability.

Training rows: labels whose crc32(doc_id) mod 4 is 0 or 1 feed the counts, those with 3 the
calibration, those with 2 nothing. At most about ``MOST_LABELS`` rows of labels are used, drawn
by hash; corpus counts cover every document. The label, lang, source and doc_id of a document
are no inputs of its score.

Defined results: a null or empty text has no passage and the score of a text without any; rows
with null labels are not used, a document labelled twice is toxic if either says so; without
toxic or without clean training rows every token scores nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtrail.llm.shared import Memo, text_or_empty
from rxtrail.sources.staging import Staging

MOST_LABELS = 500_000
PRIOR = 0.05
SHARE = 0.1
SIGNIFICANT = 0.05
EULER = 0.5772156649015329
MARKS = ".,;:!?*$%&#|<>()[]{}\"'`~^_=+-/\\"
PREFIXES = range(3, 9)
MEMO_WORDS = 150_000
#: A task holds so many counts, those of one document at least, then sums them and hands them on.
HELD = 1 << 21


def words_of(text: str) -> list[str]:
    return [w.strip(MARKS) for w in text.lower().split()]


def features_of(word: str) -> list[int]:
    """Hashes of the word and of its beginnings."""
    names = [word, *("^" + word[:n] for n in PREFIXES if n <= len(word))]
    return [xxhash.xxh3_64_intdigest(x) for x in names]


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in one scan.

    Only tokens with a positive score start or end a segment, so the scan steps over those;
    running sums give what lies between them.
    """
    sums = np.cumsum(scores)
    found: list[list] = []  # start, end, sum before it, sum with it
    for i in np.flatnonzero(scores > 0).tolist():
        right = float(sums[i])
        item = [i, i + 1, right - float(scores[i]), right]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= item[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= item[3]:
                found.append([*item[:4], j])
                break
            item = [found[j][0], item[1], found[j][2], item[3]]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right, _ in found]


def evidence(times: np.ndarray) -> np.ndarray:
    """How much it counts that a document has a feature so many times.

    The first four count one each, then one more per eightfold: of a document that repeats
    itself, further occurrences are ever weaker evidence, but there is no bound.
    """
    doublings = np.frexp(np.maximum(times // 4, 1).astype(np.float64))[1] - 1
    return np.where(times <= 4, times, 4 + doublings // 3).astype(np.int64)


def split_of(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4, F.lit(0))


def training_labels(labels: DataFrame, most: int) -> DataFrame:
    """doc_id and toxic (one row each) of about ``most`` rows of labels, drawn by hash."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(split_of() != 2)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = rows.count()
    share = F.pmod(F.xxhash64("doc_id", F.lit("label sample")), F.lit(1 << 20))
    return rows.where(share < round((1 << 20) * min(1.0, most / max(1, n))))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often documents have a feature: toxic, clean and all ones; totals have no feature."""
    known = Memo(MEMO_WORDS, lambda word: np.array(features_of(word), np.uint64).tobytes())
    held: list[tuple[np.ndarray, np.ndarray, int]] = []  # features, times and label of documents
    n = 0

    def handed_on() -> pa.RecordBatch:
        seen, at = np.unique(np.concatenate([f for f, _, _ in held]), return_inverse=True)
        times = np.concatenate([t for _, t, _ in held])
        label = np.repeat([x for _, _, x in held], [len(f) for f, _, _ in held])
        weights = times * (label == 1), times * (label == 0), times
        columns = [np.bincount(at, w, minlength=len(seen)).astype(np.int64) for w in weights]
        features = pa.concat_arrays([pa.array(seen.view(np.int64)), pa.array([None], pa.int64())])
        return pa.RecordBatch.from_arrays(
            [features, *(pa.array(np.r_[c, c.sum()]) for c in columns)], ["feature", "toxic", "clean", "all"]
        )

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
            found = np.frombuffer(b"".join(map(known.__getitem__, words_of(text.as_py()))), np.uint64)
            found, times = np.unique(found, return_counts=True)
            held.append((found, evidence(times), -1 if toxic is None else int(bool(toxic))))
            n += len(found) + 1
            if n >= HELD:
                yield handed_on()
                held, n = [], 0
    if held:
        yield handed_on()


class Model:
    """Positive log-odds by feature, and the constants of the extreme-value and logistic calibration."""

    def __init__(self, odds: dict[int, float]):
        self.odds = odds
        self.mean_excess = 1.0
        self.log_k = 0.0
        self.line = (-3.0, 1.0)
        self.known: Memo | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": None}

    def _excess(self, word: str) -> float:
        return math.expm1(max(self.odds.get(f, 0.0) for f in features_of(word)))

    def excess(self, text: str) -> np.ndarray:
        """By how much each token is commoner in toxic documents than in clean ones, over 1."""
        if self.known is None:
            self.known = Memo(MEMO_WORDS, self._excess)
        words = words_of(text)
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens; start, end and score of the text's segments."""
        scores = np.log(1 - SHARE + SHARE * self.excess(text) / self.mean_excess)
        return len(scores), maximal_segments(scores)

    def passages(self, text: str) -> list[tuple[int, int, float]]:
        """Significant segments: start, end, log E."""
        n, found = self.segments(text)
        chance = self.log_k + np.log(max(1, n))
        return [(a, b, chance - s) for a, b, s in found if chance - s < np.log(SIGNIFICANT)]

    def probability(self, passages: list[tuple[int, int, float]]) -> float:
        a, b = self.line
        return float(1 / (1 + np.exp(-(a + b * statistic(passages)))))


def statistic(passages: list[tuple[int, int, float]]) -> float:
    return float(np.log1p(-sum(e for _, _, e in passages)))


def fit_line(x: np.ndarray, n: np.ndarray, ones: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one variable by Newton steps; a weak prior keeps it finite."""
    beta, design = np.zeros(2), np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (ones - n * p) - 0.5 * beta
        step = np.linalg.solve((design * (n * p * (1 - p))[:, None]).T @ design + 0.5 * np.eye(2), gradient)
        beta += np.clip(step, -2, 2)
    return float(beta[0]), max(0.0, float(beta[1]))


def positive_odds(counts: DataFrame) -> dict[int, float]:
    """Shrunk log-odds of the features that toxic documents favour for sure."""
    totals = counts.where("feature IS NULL")
    toxic, clean, corpus = totals.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("toxic", "clean", "all")]).first()
    if not toxic or not clean:
        return {}
    strength = max(1.0, PRIOR * (toxic + clean))
    prior = F.col("all") * (strength / corpus)
    in_toxic, in_clean = F.col("toxic") + prior, F.col("clean") + prior
    # Conditions may be judged in any order, and the totals leave no rest to divide by.
    against = lambda own, every: F.log(F.try_divide(own, every + strength - own))
    odds = against(in_toxic, F.lit(toxic)) - against(in_clean, F.lit(clean))
    # Several times in one document are no independent evidence: counts weigh half here.
    sure = odds - 3 * F.sqrt(2 / in_toxic + 2 / in_clean)
    rows = counts.where("toxic > 0 AND feature IS NOT NULL").select("feature", sure.alias("odds")).where("odds > 0")
    return {row.feature % 2**64: row.odds for row in rows.toLocalIterator()}


def fit(docs: DataFrame, labels: DataFrame, staging: Staging, most_labels: int = MOST_LABELS) -> Model:
    spark = docs.sparkSession
    # About most_labels rows of id and label: small enough to broadcast whatever the corpus.
    known = staging.write(training_labels(labels, most_labels), "labels")
    known = F.broadcast(known.select(F.col("doc_id").alias("known_id"), "toxic", split_of().alias("split")))
    text = text_or_empty("text").alias("text")
    joined = docs.select("doc_id", text).join(known, F.col("doc_id") == F.col("known_id"), "left")
    marked = joined.select("text", F.when(F.col("split") < 2, F.col("toxic").cast("int")).alias("toxic"))
    counts = (
        marked.mapInArrow(_counts, "feature long, toxic long, clean long, all long")
        .groupBy("feature")
        .agg(*[F.sum(c).alias(c) for c in ("toxic", "clean", "all")])
        .where("toxic > 0 OR feature IS NULL")
    )
    model = Model(positive_odds(staging.write(counts, "counts")))

    rest = staging.write(joined.where("split = 3").select("text", F.col("toxic").cast("int").alias("toxic")), "rest")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [odds.value.excess(text.as_py()) for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([float(x.sum()) for x in found], pa.float64()), pa.array([len(x) for x in found], pa.int64())],
                ["excess", "n"],
            )

    odds = spark.sparkContext.broadcast(model)
    total, n = rest.select("text").mapInArrow(sums, "excess double, n long").agg(F.sum("excess"), F.sum("n")).first()
    model.mean_excess = total / n if n and total else 1.0

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = []
            for text in batch.column(0):
                n, found = scaled.value.segments(text.as_py())
                tops.append(max((s for _, _, s in found), default=0.0) - np.log(max(1, n)))
            yield pa.RecordBatch.from_arrays([pa.array(tops, pa.float64())], ["top"])

    scaled = spark.sparkContext.broadcast(model)
    top = rest.where("toxic = 0").select("text").mapInArrow(best, "top double").agg(F.avg("top")).first()[0]
    model.log_k = (top if top is not None else 0.0) - EULER
    calibrated = spark.sparkContext.broadcast(model)

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistic(calibrated.value.passages(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], ["x", "toxic"])

    # Bins of 0.05 of a logarithm: a few hundred rows at most.
    bins = rest.mapInArrow(statistics, "x double, toxic int").groupBy(F.round(F.col("x") * 20).alias("bin"))
    rows = bins.agg(F.count("*").alias("n"), F.sum("toxic").alias("ones")).toPandas()
    if len(rows):
        x, n, ones = (rows[c].to_numpy(float) for c in ("bin", "n", "ones"))
        model.line = fit_line(x / 20, n, ones)
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the passages (word positions and log E) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("log_e", pa.float64())]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = [model.passages(t.as_py()) for t in batch.column(1)]
            scores = pa.array(map(model.probability, found), pa.float64())
            rows = [[{"start": a, "end": b, "log_e": float(e)} for a, b, e in p] for p in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), scores, pa.array(rows, passage)], ["doc_id", "score", "passages"])

    rows = docs.select("doc_id", text_or_empty("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(of, f"doc_id {kind}, score double, passages array<struct<start:long,end:long,log_e:double>>")


def report(docs: DataFrame, labels: DataFrame, staging: Staging) -> DataFrame:
    found = scored(docs, fit(docs, labels, staging))
    return found.select(
        "doc_id", (split_of() == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "passages"
    )
