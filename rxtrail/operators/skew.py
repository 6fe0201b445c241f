"""Joins and per-key work that stay balanced when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtrail.config import SkewLimits
from rxtrail.operators.bloom import may_be_among
from rxtrail.sources.staging import Staging


@dataclass(frozen=True)
class HotKeys:
    """The keys with many rows, each with the number of slots its rows are dealt over."""

    keys: tuple[str, ...]
    frame: DataFrame

    def within(self, rows: DataFrame, inside: bool = True) -> DataFrame:
        """Only the rows of hot keys, or only the others."""
        return equi_join(
            rows,
            F.broadcast(self.frame.select(*self.keys)),
            self.keys,
            "left_semi" if inside else "left_anti",
            null_safe=True,
        )


def find_hot_keys(
    rows: DataFrame,
    keys: Sequence[str],
    limits: SkewLimits,
    staging: Staging,
) -> HotKeys | None:
    """Keys with too many rows for one task, or None where there are none.

    The rows are counted once, by a grouped aggregate whose hot keys are written: every
    later use sees the same keys, and looking whether there are any reads the written copy.
    The threshold does not grow with the data, so no task's share does; more than
    ``max_hot_keys`` such keys (a table of 250 billion rows, all of them in hot keys) are
    refused rather than broadcast.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    slots = F.ceil(F.col("n_rows") / limits.hot_rows).cast("int").alias("n_slots")
    hot = staging.write(counts.where(F.col("n_rows") >= limits.hot_rows).select(*keys, slots), "hot_keys")
    n_hot = hot.count()
    if n_hot > limits.max_hot_keys:
        raise ValueError(f"{n_hot} hot keys of {', '.join(keys)}: raise hot_rows or max_hot_keys")
    return HotKeys(tuple(keys), hot) if n_hot else None


def equi_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, null_safe: bool = False
) -> DataFrame:
    """Join on equally named keys, optionally letting NULL keys match each other."""
    if not null_safe:
        return left.join(right, list(keys), how)
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    condition = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    hot: HotKeys | None,
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Attach to each row what ``lookup`` holds for its key.

    Rows of hot keys are dealt over slots by a hash of the whole row (so there should be few
    copies of a row), and their lookup rows repeated once per slot: no task gets a whole hot
    key. Other rows keep slot 0. ``hot`` may be on fewer columns than ``keys``.
    """
    if hot is None:
        return equi_join(rows, lookup, keys, how, null_safe)
    slots = F.broadcast(hot.frame)
    n_slots = F.coalesce(F.col("n_slots"), F.lit(1))
    row_hash = F.xxhash64(*rows.columns)
    slot = F.pmod(row_hash, n_slots).cast("int")
    if not null_safe:
        # A NULL key matches nothing, so such rows may go anywhere.
        no_key = reduce(or_, [F.col(key).isNull() for key in keys])
        anywhere = F.pmod(row_hash, F.lit(1 << 20)).cast("int")
        slot = F.when(no_key, anywhere).otherwise(slot)
    dealt = equi_join(rows, slots, hot.keys, "left", null_safe=True)
    dealt = dealt.withColumn("_slot", slot).drop("n_slots")
    repeated = equi_join(lookup, slots, hot.keys, "left", null_safe=True)
    repeated = repeated.withColumn("_slot", F.explode(F.sequence(F.lit(0), n_slots - 1)))
    return equi_join(dealt, repeated.drop("n_slots"), [*keys, "_slot"], how, null_safe).drop(
        "_slot"
    )


def dimension_join(
    rows: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    limits: SkewLimits,
    staging: Staging,
    how: str = "left",
) -> DataFrame:
    """Join a dimension of a few fixed-width columns to rows whose copies do not matter.

    It is counted first: up to ``broadcast_rows`` rows it is broadcast and the rows do not
    move. Beyond that a Bloom filter of its keys, a megabyte whatever their number, tells at the
    scan which rows may match: only those shuffle by key, those without a match or a key stay
    where they are. Rows of hot keys are dealt over slots, without their copies, which would all
    go to one. ``rows`` are read once for each of these, so they should be a scan of the columns
    needed, or stored.
    """
    if dimension.count() <= limits.broadcast_rows:
        return rows.join(F.broadcast(dimension), list(keys), how)
    may_match = reduce(and_, [F.col(key).isNotNull() for key in keys])
    may_match &= may_be_among(dimension.select(*keys), keys, staging)
    keyed = rows.where(may_match)

    def join(part: DataFrame, is_hot: bool) -> DataFrame:
        if is_hot:
            return lookup_join(part.distinct(), dimension, keys, hot, how)
        return equi_join(part, dimension, keys, how)

    hot = find_hot_keys(keyed, keys, limits, staging)
    joined = per_key(keyed, hot, join)
    if how == "left_semi":
        return joined
    return joined.unionByName(rows.where(~may_match), allowMissingColumns=True)


def shuffled_by(rows: DataFrame, keys: Sequence[str], n_rows: int, limits: SkewLimits) -> DataFrame:
    """``rows``, of which there are ``n_rows``, by key in tasks of about ``hot_rows`` rows or fewer.

    Work that sorts and groups a task's rows many times over needs far more memory than the bytes
    that it reads. Spark sizes tasks by these bytes; a number of tasks that is stated holds.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-n_rows // limits.hot_rows)), *keys)


def per_key(
    rows: DataFrame, hot: HotKeys | None, work: Callable[[DataFrame, bool], DataFrame]
) -> DataFrame:
    """Run ``work(rows, is_hot)``, with ``is_hot`` set only for the rows of hot keys."""
    if hot is None:
        return work(rows, False)
    return work(hot.within(rows, inside=False), False).unionByName(work(hot.within(rows), True))
