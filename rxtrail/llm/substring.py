"""Passages that repeat across documents, by Rabin-Karp hashes of every 13-word window.

A window is removed from a document if its words also start somewhere in a document with a
smaller id. Hashes are polynomials over word hashes modulo 2^64, rolled by prefix sums.

* A task hashes all windows of a run of documents, and within the run finds for each window
  the least document. Documents of the run that repeat it get removal intervals at once, so a
  passage in a third of all rows leaves a run as one entry.
* One entry per distinct window (hash and least id) goes to the bucket of its hash. Entries
  travel sorted, as differences split into byte planes and compressed: about seven bytes.
* A bucket finds the least document of each window overall and sends the hashes that later
  ones lose to those documents' lanes, all for one lane in one row.
* Documents meet what is sent to their lane and mark the windows; overlapping windows merge
  into maximal intervals, and what lies outside is kept.

Texts move once, to meet their removals. Buckets and lanes are as many as the bytes of all texts
need for ``LANE_BYTES`` each, so a table in a task is bounded whatever the number of partitions;
a document's lane is a hash of its id, so ids with a common factor spread as well; a run is
bounded by its words. Equality is by 64-bit hash: among n windows the chance of any false match is
about n^2 / 2^65 (1 in 2,000 for 133 million windows; of 10^13 windows, 100 TB, some millions
would match falsely).

Defined results: a null text has no words; fewer than 13 words make no window; ids compare
as integers; rows without an id come after all others, by a hash of their text (as ids within
2^44 of the largest possible one do); rows that share an id, or a text and no id, don't remove
each other's words and share a lane; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rxtrail.llm.shared import text_or_empty

WINDOW = 13
RUN_WORDS = 1 << 21
BUCKETS_PER_PARTITION = 2
LANE_BYTES = 32 << 20
NO_ID = np.iinfo(np.int64).max
#: An odd multiplier and its inverse modulo 2^64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


#: The primes of XXH64.
PRIMES = [np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)]


def hashed(keys: np.ndarray) -> np.ndarray:
    """XXH64 of 64-bit integers with seed 42, which is what Spark's xxhash64 gives for one."""
    p1, p2, p3, p4, p5 = PRIMES
    turned = lambda x, n: x << np.uint64(n) | x >> np.uint64(64 - n)
    h = turned(keys.astype(np.int64).view(np.uint64) * p2, 31) * p1 ^ (np.uint64(42 + 8) + p5)
    h = turned(h, 27) * p1 + p4
    h = (h ^ h >> np.uint64(33)) * p2
    h = (h ^ h >> np.uint64(29)) * p3
    return h ^ h >> np.uint64(32)


def lanes_of(keys: np.ndarray, lanes: int) -> np.ndarray:
    return np.mod(hashed(keys).view(np.int64), lanes)


class Powers:
    """Powers of a number modulo 2^64, extended as needed."""

    def __init__(self, base: int):
        self.base = np.uint64(base)
        self.known = np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            factors = np.full(max(n, 2 * len(self.known)), self.base, np.uint64)
            factors[0] = 1
            self.known = np.cumprod(factors)
        return self.known[:n]


UP, DOWN = Powers(BASE), Powers(BASE_INVERSE)


def window_hashes(words: list[bytes], window: int) -> np.ndarray:
    n = len(words) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(hashes * UP.upto(len(words)), out=sums[1:])
    return (sums[window:] - sums[:-window]) * DOWN.upto(n)


def merged(starts: np.ndarray, window: int) -> np.ndarray:
    """Maximal intervals (start, end) covered by windows at sorted starts."""
    if not len(starts):
        return np.empty((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    first, last = np.r_[0, cut], np.r_[cut - 1, len(starts) - 1]
    return np.stack([starts[first], starts[last] + window], axis=1)


def pack(values: np.ndarray) -> bytes:
    """64-bit integers as compressed byte planes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.uint64).ravel()


ENTRIES = pa.schema(
    [
        ("bucket", pa.int32()),
        ("hashes", pa.binary()),  # differences of sorted window hashes
        ("ids", pa.binary()),  # least id of each in the run, less ``base``
        ("base", pa.int64()),
        ("doc_key", pa.int64()),  # else, removals found within the run
        ("tag", pa.int64()),
        ("spans", pa.binary()),
    ]
)
REMOVALS = "lane int, ids binary, hashes binary, doc_key long, tag long, spans binary"


def _entries_of_run(keys: list[int], tags: list[int], windows: list[np.ndarray], window: int, buckets: int) -> pa.RecordBatch:
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    keys_up = np.array(keys, np.int64)[order]
    lengths = np.array([len(windows[i]) for i in order], np.int64)
    doc = np.repeat(np.arange(len(order)), lengths)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    hashes = np.concatenate([windows[i] for i in order]) if len(order) else np.empty(0, np.uint64)
    rank = np.argsort(hashes, kind="stable")  # equal hashes stay in order of id
    hashes = hashes[rank]
    new = np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)]
    owner = keys_up[doc[rank]][new]
    rows = []
    later = rank[keys_up[doc[rank]] > owner[np.cumsum(new) - 1]]
    later.sort()
    for part in np.split(later, np.flatnonzero(np.diff(doc[later])) + 1) if len(later) else []:
        d = doc[part[0]]
        key = int(keys_up[d])
        spans = merged(at[part], window).astype(np.int64)
        rows.append((int(lanes_of(np.array([key]), buckets)[0]), None, None, None, key, tags[order[d]], pack(spans.ravel())))
    hashes = hashes[new]
    place = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    edges = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][: len(place)])
    for start, end in zip(edges, np.r_[edges[1:], len(place)], strict=False):
        some, ids = hashes[start:end], owner[start:end]
        base = int(ids.min())
        gaps = np.diff(some, prepend=np.uint64(0))
        rows.append((int(place[start]), pack(gaps), pack(ids.view(np.uint64) - ids.min().view(np.uint64)), base, None, None, None))
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in ENTRIES]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ENTRIES, strict=True)], schema=ENTRIES)


def _entries(window: int, buckets: int, run_words: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, tags, windows, size = [], [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = text.as_py()
                found = window_hashes(data.split(), window)
                if len(found):
                    keys.append(key)
                    tags.append(_tag(data))
                    windows.append(found)
                    size += len(found)
                if size >= run_words:
                    yield _entries_of_run(keys, tags, windows, window, buckets)
                    keys, tags, windows, size = [], [], [], 0
        if keys:
            yield _entries_of_run(keys, tags, windows, window, buckets)

    return of


def _tag(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data, 1) - (1 << 63)


def _removals(lanes: int):
    """Of one bucket: the windows of documents that start in a smaller one, and what was known."""
    names = ["lane", "ids", "hashes", "doc_key", "tag", "spans"]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]

    def of(table: pa.Table) -> pa.Table:
        known = table.filter(pc.is_valid(table["doc_key"]))
        nothing = [None] * len(known)
        taken = [known[n].to_pylist() for n in ("bucket", "doc_key", "tag", "spans")]
        out = [taken[0], nothing, nothing.copy(), *taken[1:]]
        entries = table.filter(pc.is_valid(table["base"]))
        if len(entries) > 1:
            hashes = np.concatenate([np.cumsum(unpack(x.as_py())) for x in entries["hashes"]])
            ids = np.concatenate([
                (unpack(x.as_py()) + np.int64(base).view(np.uint64)).view(np.int64)
                for x, base in zip(entries["ids"], entries["base"].to_pylist(), strict=True)
            ])
            order = np.argsort(hashes)
            hashes, ids = hashes[order], ids[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]]
            least = np.minimum.reduceat(ids, np.flatnonzero(new))[np.cumsum(new) - 1]
            hashes, ids = hashes[ids > least], ids[ids > least]
            lane = lanes_of(ids, lanes)
            order = np.lexsort((ids, lane))
            hashes, ids, lane = hashes[order], ids[order], lane[order]
            edges = np.flatnonzero(np.r_[True, lane[1:] != lane[:-1]][: len(ids)])
            for start, end in zip(edges, np.r_[edges[1:], len(ids)], strict=False):
                gaps = np.diff(ids[start:end], prepend=0)
                row = (int(lane[start]), pack(gaps), hashes[start:end].tobytes(), None, None, None)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return of


def _clean(window: int, id_type: pa.DataType):
    def of(docs: pa.Table, removals: pa.Table) -> pa.Table:
        sent = removals.filter(pc.is_valid(removals["hashes"]))
        ids = np.concatenate([np.empty(0, np.int64), *(np.cumsum(unpack(x.as_py()).view(np.int64)) for x in sent["ids"])])
        hashes = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(x.as_py(), np.uint64) for x in sent["hashes"])])
        order = np.argsort(ids, kind="stable")
        ids, hashes = ids[order], hashes[order]
        known = removals.filter(pc.is_valid(removals["spans"]))
        spans = dict(zip(zip(known["doc_key"].to_pylist(), known["tag"].to_pylist(), strict=True), known["spans"], strict=True))
        n_words, intervals, kept = [], [], []
        keys = docs["doc_key"].to_numpy()
        firsts, lasts = np.searchsorted(ids, keys), np.searchsorted(ids, keys, "right")
        for key, text, first, last in zip(keys.tolist(), docs["text"], firsts, lasts, strict=True):
            data = text.as_py()
            words = data.split()
            found = spans.get((key, _tag(data))) if spans else None
            gone = _marked(words, hashes[first:last], found, window)
            intervals.append([{"start": a, "end": b} for a, b in gone])
            n_words.append(len(words))
            for a, b in reversed(gone):
                del words[a:b]
            kept.append(b" ".join(words).decode("utf-8", "replace"))
        return pa.table(
            [docs["doc_id"].cast(id_type), pa.array(n_words, pa.int64()), pa.array(intervals, SPANS), pa.array(kept, pa.string())],
            ["doc_id", "n_words", "removed", "kept"],
        )

    return of


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _marked(words: list[bytes], sent: np.ndarray, spans: pa.Scalar | None, window: int) -> list[list[int]]:
    """Maximal intervals of removed words."""
    if not len(sent) and spans is None:
        return []
    edge = np.zeros(len(words) + 1, np.int64)
    if len(sent):
        at = np.flatnonzero(np.isin(window_hashes(words, window), sent))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
    if spans is not None:
        pairs = unpack(spans.as_py()).view(np.int64).reshape(-1, 2)
        np.add.at(edge, pairs[:, 0], 1)
        np.add.at(edge, pairs[:, 1], -1)
    inside = np.r_[0, np.cumsum(edge[:-1]) > 0, 0]
    return np.flatnonzero(np.diff(inside)).reshape(-1, 2).tolist()


def cleaned(docs: DataFrame, window: int = WINDOW, run_words: int = RUN_WORDS, lane_bytes: int = LANE_BYTES) -> DataFrame:
    """doc_id, n_words, removed (maximal word intervals) and kept (the other words, joined)."""
    lanes = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lanes = max(lanes, -(-n_bytes // lane_bytes))
    parts = max(1, lanes // BUCKETS_PER_PARTITION)
    text = text_or_empty("text")
    without = F.lit(int(NO_ID)) - F.pmod(F.xxhash64(text), F.lit(1 << 44))
    key = F.coalesce(F.col("doc_id").cast("long"), without)
    rows = docs.select("doc_id", key.alias("doc_key"), text.cast("binary").alias("text"))
    kinds = "bucket int, hashes binary, ids binary, base long, doc_key long, tag long, spans binary"
    entries = rows.select("doc_key", "text").mapInArrow(_entries(window, lanes, run_words), kinds)
    removals = entries.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_removals(lanes), REMOVALS)
    lane = F.pmod(F.xxhash64("doc_key"), F.lit(lanes)).cast("int").alias("lane")
    kind = docs.schema["doc_id"].dataType
    return (
        rows.select("doc_id", "doc_key", "text", lane)
        .repartition(parts, "lane")
        .groupBy("lane")
        .cogroup(removals.repartition(parts, "lane").groupBy("lane"))
        .applyInArrow(
            _clean(window, to_arrow_type(kind)),
            f"doc_id {kind.simpleString()}, n_words long, removed array<struct<start:long,end:long>>, kept string",
        )
    )


def report(docs: DataFrame) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return cleaned(docs).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


SQL_REPORT = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, list_slice(ws, i, i + 12) AS x FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS i FROM w)),
least AS (SELECT x, min(doc_id) AS m FROM win GROUP BY x HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 12)) AS k FROM win JOIN least USING (x) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(generate_series(1, len(ws))) AS k FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS t FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""
