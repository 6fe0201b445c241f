"""Near duplicates by SimHash, found with the words of a covering code as anchors.

Fingerprints have 64 bits; two link if at most ``DISTANCE`` = 2 bits differ.

The anchors are the code words of G + G + {0}, where G is the binary Golay code of length 23
(every 23-bit word lies within 3 bits of exactly one code word) and the last 18 bits are left
to the comparison. A fingerprint's home is the one anchor within the covering radius in each
block. It is also copied to every anchor within the radius plus the distance, the excess over
the radius counted over both blocks together: 68 copies at most. If x and y differ in two
bits, y is at most two bits further than the radius from the home of x, so the two meet there.
Per anchor, homes are compared with all that came, by exact bit distance.

What bounds the work: fingerprints are made distinct first, so copies cost nothing. A task
streams rows sorted by anchor and holds the homes of one anchor only, and no more than
``MOST_HOMES``: fuller anchors deal homes over lanes and copy the rest to each. A row that
matches several homes yields one link, and homes that it ties together yield links only until
they are connected, so a dense anchor gives a few links per row instead of all pairs.
Components come from alternating large and small stars over stored tables.

Defined results: a null or blank text has fingerprint 0, linked like any other; a text of one
or two words is one shingle; equal rows share a component; null ids never name a component
that has another id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtrail.llm.exact import located
from rxtrail.llm.shared import text_or_empty
from rxtrail.sources.staging import Staging

SHINGLE = 3
DISTANCE = 2
SEED = 42
MOST_HOMES = 4096
LANES = 16
BLOCK_BITS, RADIUS, CHECK_BITS = 23, 3, 11
# Fixed value: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the binary Golay code.
GENERATOR = 0b110001110101
PIECE = 1 << 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the hashes of the text's shingles."""
    # bytes.lower changes A-Z only, and bytes.split() splits at the six ASCII separators only.
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(shingles), PIECE):
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[i : i + PIECE]], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, text: str) -> DataFrame:
    """``place``, ``doc_id`` and ``fp`` (64 bits as a long) of rows with place, doc_id and a text."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(x.as_py()) for x in batch.column(2)]
            fp = pa.array(np.array(prints, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fp], ["place", "doc_id", "fp"])

    taken = rows.select("place", F.col("doc.doc_id").alias("doc_id"), text_or_empty(F.col("doc")[text]).cast("binary").alias("text"))
    kind = taken.schema["doc_id"].dataType.simpleString()
    place = taken.schema["place"].dataType.simpleString()
    return taken.mapInArrow(of, f"place {place}, doc_id {kind}, fp long")


def _remainder(words: np.ndarray) -> np.ndarray:
    """Syndromes: remainders of 23-bit words by the generator."""
    left = words.astype(np.int64)
    for bit in range(BLOCK_BITS - 1, CHECK_BITS - 1, -1):
        left = np.where(left >> bit & 1, left ^ GENERATOR << (bit - CHECK_BITS), left)
    return left


@cache
def _cosets() -> list[np.ndarray]:
    """By excess 0, 1, 2 and syndrome, the errors that lead to code words (padded with -1)."""
    tables = []
    for excess in range(DISTANCE + 1):
        weights = range(RADIUS + 1) if excess == 0 else [RADIUS + excess]
        errors = np.array([sum(1 << i for i in c) for w in weights for c in combinations(range(BLOCK_BITS), w)])
        at = _remainder(errors)
        order = np.argsort(at, kind="stable")
        errors, at = errors[order], at[order]
        count = np.bincount(at, minlength=1 << CHECK_BITS)
        place = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)
        table = np.full((1 << CHECK_BITS, count.max()), -1, np.int64)
        table[at, place] = errors
        tables.append(table)
    return tables


def _reachable(block: np.ndarray) -> list[np.ndarray]:
    """Per excess, the code words (as their 12 leading bits, or -1) around each 23-bit word."""
    syndromes = _remainder(block)
    errors = [t[syndromes] for t in _cosets()]
    return [np.where(e < 0, -1, (block[:, None] ^ e) >> CHECK_BITS) for e in errors]


def anchors(fps: np.ndarray, copies: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, index of the fingerprint, and whether it is away from home, of each copy."""
    bits = fps.view(np.uint64)
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    first = _reachable((bits & mask).astype(np.int64))
    second = _reachable((bits >> np.uint64(BLOCK_BITS) & mask).astype(np.int64))
    index = np.arange(len(fps))
    found = []
    for a in range(DISTANCE + 1 if copies else 1):
        for b in range(DISTANCE + 1 - a if copies else 1):
            x, y = first[a][:, :, None], second[b][:, None, :]
            both = np.where((x < 0) | (y < 0), -1, x << 12 | y).reshape(len(fps), -1)
            row, column = np.nonzero(both >= 0)
            found.append((both[row, column], index[row], np.full(len(row), a + b > 0)))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 2048):
            fps = batch.column(0).slice(part, 2048).to_numpy(zero_copy_only=False)
            anchor, index, away = anchors(fps)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.astype(np.int32)), pa.array(fps[index]), pa.array(away)], ["anchor", "fp", "away"]
            )


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, _, _ = anchors(batch.column(0).to_numpy(zero_copy_only=False), copies=False)
        yield pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32))], ["anchor"])


class Bucket:
    """Homes of the anchor at hand, and which of them are known to be connected."""

    def __init__(self, key: int):
        self.key = key
        self.homes = np.empty(0, np.int64)
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = x = self.parent.get(up, up)
        return x

    def links(self, fps: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links that connect each fingerprint with all homes near it."""
        step = max(1, (1 << 21) // max(1, len(self.homes)))
        for i in range(0, len(fps), step):
            some = fps[i : i + step]
            # Of signed numbers, bitwise_count counts the bits of the absolute value.
            near = np.bitwise_count((some[:, None] ^ self.homes[None, :]).view(np.uint64)) <= DISTANCE
            for x, row in zip(some[(n := near.sum(axis=1)) > 0].tolist(), near[n > 0], strict=True):
                homes = self.homes[row].tolist()
                if homes[0] != x:
                    yield x, homes[0]
                top = self.root(homes[0])
                for h in homes[1:]:
                    if (other := self.root(h)) != top:
                        self.parent[other] = top
                        if x != h:
                            yield x, h


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within runs of one bucket; rows come sorted by bucket, homes first."""
    bucket = Bucket(-1)
    for batch in batches:
        key = batch.column(0).to_numpy(zero_copy_only=False)
        fps = batch.column(1).to_numpy(zero_copy_only=False)
        away = batch.column(2).to_numpy(zero_copy_only=False)
        found: list[tuple[int, int]] = []
        # Most buckets have no home, or nothing but one: only runs with a home are looked at.
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        ends = np.r_[starts[1:], len(key)]
        first = starts[0] if len(starts) else 0
        worth = ~away[starts] & (ends - starts > 1)
        worth[:1] |= len(key) > 0
        worth[-1:] |= len(key) > 0
        for start, end in zip(starts[worth].tolist(), ends[worth].tolist(), strict=True):
            if not (start == first and key[start] == bucket.key):
                bucket = Bucket(int(key[start]))
            homes = fps[start:end][~away[start:end]]
            bucket.homes = np.concatenate([bucket.homes, homes])
            if len(bucket.homes):
                found.extend(bucket.links(fps[start:end]))
        if found:
            u, v = np.array(found, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], ["u", "v"])


def links(distinct: DataFrame, staging: Staging, most_homes: int = MOST_HOMES) -> DataFrame:
    """Links (u > v) that connect all fingerprints within the distance, stored."""
    homes = distinct.select("fp").mapInArrow(_homes, "anchor int").groupBy("anchor").count()
    # At most one in most_homes fingerprints is such an anchor; few enough, they are broadcast.
    crowded = staging.write(
        homes.where(F.col("count") > most_homes).select("anchor", F.ceil(F.col("count") / most_homes).alias("lanes")),
        "crowded",
    )
    rows = distinct.select("fp").mapInArrow(_copies, "anchor int, fp long, away boolean")
    if crowded.isEmpty():
        keyed = rows.select(F.col("anchor").cast("long").alias("bucket"), "fp", "away")
    else:
        lanes = F.coalesce("lanes", F.lit(1))
        own = F.pmod(F.xxhash64("fp"), lanes)
        every = F.sequence(F.lit(0).cast("long"), lanes - 1)
        keyed = rows.join(crowded, "anchor", "left").select(
            "anchor", "fp", "away", F.explode(every).alias("lane"), own.alias("own")
        ).select(
            F.xxhash64("anchor", "lane").alias("bucket"), "fp", (F.col("away") | (F.col("lane") != F.col("own"))).alias("away")
        )
    met = keyed.repartition("bucket").sortWithinPartitions("bucket", "away")
    return staging.write(met.mapInArrow(_compare, "u long, v long").distinct(), "links")


def components(edges: DataFrame, staging: Staging) -> DataFrame:
    """``fp`` and ``root`` (the least of its component) for every fingerprint with a link."""

    def stars(rows: DataFrame) -> DataFrame:
        """Each row's v meets the least v of its u; keys are dealt over lanes."""
        least = rows.groupBy("u").agg(F.min("v").alias("least"))
        lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
        least = least.select(F.col("u").alias("of"), "least", lanes.alias("lane"))
        lane = F.pmod(F.xxhash64("v"), F.lit(LANES))
        return rows.join(least, (F.col("u") == F.col("of")) & (lane == F.col("lane")))

    def state(rows: DataFrame) -> tuple:
        return tuple(rows.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    last = None
    while (now := state(edges)) != last:
        last = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both).where("v > u").select(
            F.col("v").alias("u"), F.least("least", "of").alias("v")
        ).distinct()
        large = staging.write(large, "large")
        met = stars(large)
        small = met.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        kept = large.groupBy("u").agg(F.min("v").alias("v"))
        edges = staging.write(small.unionByName(kept).distinct(), "small")
    root = edges.select("v").distinct().select(F.col("v").alias("fp"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(root)


def classes(docs: DataFrame, staging: Staging) -> DataFrame:
    """place, doc_id, fp, root and component_id for every document."""
    prints = staging.write(fingerprints(located(docs, staging), "text"), "prints")
    distinct = staging.write(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "distinct"
    )
    roots = staging.write(components(links(distinct, staging), staging), "roots")
    rooted = distinct.join(roots, "fp", "left").where("n > 1 OR root IS NOT NULL").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    shared = staging.write(rooted.select("fp", "root").join(ids, "root"), "shared")
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
    # A merge join: what is shared grows with the corpus, and the lanes multiply it.
    dealt = shared.select(F.col("fp").alias("of"), "root", "component_id", lanes.alias("lane")).hint("merge")
    lane = F.pmod(F.xxhash64("place"), F.lit(LANES))
    alone = F.col("of").isNull()
    return prints.join(dealt, (F.col("fp") == F.col("of")) & (lane == F.col("lane")), "left").select(
        "place", "doc_id", "fp",
        F.coalesce("root", "fp").alias("root"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def report(docs: DataFrame, staging: Staging) -> DataFrame:
    found = classes(docs.select("doc_id", "text"), staging)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def kept(docs: DataFrame, staging: Staging) -> DataFrame:
    """One document of each component (least id, then first place), in the columns of ``docs``."""
    found = staging.write(classes(docs, staging), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    many = found.groupBy("root").agg(F.min(order).alias("stays"), F.count("*").alias("n")).where("n > 1")
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1)))
    many = many.select(F.col("root").alias("of"), "stays", lanes.alias("lane")).hint("merge")
    lane = F.pmod(F.xxhash64("place"), F.lit(LANES))
    dropped = found.join(many, (F.col("root") == F.col("of")) & (lane == F.col("lane"))).where(
        F.col("place") != F.col("stays.place")
    )
    dropped = staging.write(dropped.select(F.col("place").alias("dropped")), "dropped_near")
    rows = located(docs, staging)
    return rows.join(dropped, F.col("place") == F.col("dropped"), "left_anti").select("doc.*")
