"""A Bloom filter as a condition: keeps the rows of wanted keys at their scan, before any shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.sources.staging import Staging

#: A megabyte, however many keys: 3 % of other keys pass with a million in it, 22 % with two and a half.
BITS = 1 << 23
HASHES = 3


def _places(keys: Sequence[str], bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(bits)) for i in range(hashes)]


def may_be_among(
    wanted: DataFrame, keys: Sequence[str], staging: Staging, bits: int = BITS, hashes: int = HASHES
) -> Column:
    """A condition that holds for all rows with a key in ``wanted``, and for few others.

    The filter is one row, an array of ``bits`` / 64 numbers, whatever the number of keys: tasks
    set bits by a partial aggregate, and only whole words meet. NULL keys are keys like others.
    """
    words = wanted.select(F.explode(F.array(*_places(keys, bits, hashes))).alias("place")).select(
        F.expr("shiftright(place, 6)").alias("word"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bits")
    )
    every = wanted.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = words.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    stored = staging.write(words.agg(F.transform(in_order, lambda w: w["bits"]).alias("words")), "bloom")
    filled = stored.scalar()
    tests = [
        F.getbit(F.get(filled, F.shiftright(place, 6).cast("int")), (place % 64).cast("int")) == 1
        for place in _places(keys, bits, hashes)
    ]
    return reduce(and_, tests)
