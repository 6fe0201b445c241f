"""Mixes sources to target weights by repeating documents.

Tokens are summed per source, each source gets a target, and target / tokens is the rate at
which its documents repeat: every document floor(rate) times, and once more if a hash of its
id and its source's seed, read as a number in [0, 1), is below the fraction. No state is kept,
so any task can be run again and any two runs agree.

Targets: sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share all
words; none may exceed three times its own words, and what it can't take is shared out again
by weight. With sources in order of words per weight those at their limit come first, so one
pass of running sums finds them all. Ranks and sums run over ranges of sources, each range from
where the one before it ended, so sources may be as many as documents.

Seeds: a few long documents can carry one draw far from its target. So each source draws under
``SEEDS`` seeds, and keeps one of the two whose words lie next to the target below and above:
the nearer it is, the likelier, so that the words expected are the target. A source of one
document thus still takes it with the probability of the fraction. Only sums of sizes are
needed for this, one per seed and source.

Defined results: a null text has size 0; a source without words has target 0 and its
documents are taken 0 times their size; rows with one doc_id and source draw alike, as do those
without an id; an empty table gives an empty result; other columns are carried along unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rxtrail.llm.shared import text_or_empty, words
from rxtrail.sources.staging import Staging

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix-1"
#: Draws that a source may choose from.
SEEDS = 64
#: Rates of so many sources are broadcast; beyond, those of the sources with most documents.
BROADCAST_SOURCES = 100_000
#: Hashes are 13 hexadecimal digits.
ONE = 2**52


def _running(rows: DataFrame, key: Column, sums: dict[str, Column], staging: Staging, name: str) -> DataFrame:
    """``rows`` with the sums over all rows of a lesser ``key``, which no two rows share.

    Rows are stored by ranges of the key, a file each. The window over files has one row for each,
    and those are no more than there are shuffle partitions.
    """
    stored = staging.write(rows.repartitionByRange(key), name).select("*", F.col("_metadata.file_path").alias("range"))
    of_range = stored.groupBy("range").agg(F.min(key).alias("first"), *[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = W.orderBy("first").rowsBetween(W.unboundedPreceding, -1)
    before = of_range.select(F.col("range").alias("of"), *[F.sum(n).over(earlier).alias(f"{n}_before") for n in sums])
    within = W.partitionBy("range").orderBy(key).rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    total = lambda n, c: F.coalesce(f"{n}_before", zero) + F.coalesce(F.sum(c).over(within), zero)
    joined = stored.join(F.broadcast(before), F.col("range") == F.col("of"))
    return joined.select(*rows.columns, *[total(n, c).alias(n) for n, c in sums.items()])


def source_targets(
    sized: DataFrame, staging: Staging, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """source, source_size, n_docs, target and rate from rows with ``source`` and ``size``."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    name = (F.col("source").isNull().alias("last"), F.col("source"))  # code point order, null last
    ranked = _running(totals, F.struct(*name), {"rank": F.lit(1).cast("long")}, staging, "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight).drop("rank")
    ratio = F.struct((F.col("source_size") / F.col("weight")).alias("ratio"), *name)
    lesser = {"lesser_size": F.col("source_size"), "lesser_weight": F.col("weight")}
    ordered = staging.write(_running(weighed, ratio, lesser, staging, "weighed"), "ordered")
    every = ordered.agg(F.sum("source_size"), F.sum("weight")).first()
    size, all_weights = (value or 0 for value in every)

    exact = lambda c: c.cast("decimal(38,0)")
    room = (F.lit(size).cast("long") - most * F.col("lesser_size")).alias("open")
    room_weight = (F.lit(all_weights).cast("long") - F.col("lesser_weight")).alias("open_weight")
    full = exact(F.col("source_size") * most) * exact(F.col("open_weight")) < exact(F.col("weight")) * exact(F.col("open"))
    judged = ordered.select("source", "source_size", "n_docs", "weight", room, room_weight).withColumn("full", full)
    # The level is that of the first source with room: one row.
    level = judged.where("NOT full").agg(F.max(F.struct("open_weight", "open")).alias("level")).first().level
    share = F.lit(None).cast("double")
    if level is not None:
        # A Python number below 2^31 is an int column, and its product with the weight would be one.
        share = (F.col("weight") * F.lit(level.open).cast("long")).cast("double") / F.lit(float(level.open_weight))
    target = F.when(F.col("full"), (F.col("source_size") * most).cast("double")).otherwise(share)
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    return judged.withColumn("target", target).select("source", "source_size", "n_docs", "target", rate.alias("rate"))


def _hashes(value: Column, seed: str) -> tuple[Column, Column]:
    """Two numbers below ``ONE``."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(value.cast("string"), F.lit("null"))))
    return tuple(F.conv(F.substring(digest, at, 13), 16, 10).cast("long") for at in (1, 14))


def _is_drawn(first: Column, second: Column, k: int | Column, rate: Column) -> Column:
    """Under seed ``k`` a document draws first + k * second, modulo ``ONE``."""
    number = (first + F.lit(k).cast("long") * second).bitwiseAND(F.lit(ONE - 1))
    return number.cast("double") / float(ONE) < rate - F.floor(rate)


def _with_source(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """``rows`` (with ``of_source``) and their source's rates as ``of``.

    Up to ``BROADCAST_SOURCES`` sources are broadcast. Beyond, only the sources that hold more than
    one in so many documents are, of which there are fewer; rows of all others meet their source by
    a shuffle, in which none is large.
    """
    of = rates.select(F.struct("*").alias("of"))
    same = F.col("of_source").eqNullSafe(F.col("of.source"))
    counted = rates.agg(F.count("*").alias("n"), F.sum("n_docs").alias("n_docs")).first()
    if counted.n <= BROADCAST_SOURCES:
        return rows.join(F.broadcast(of), same)
    is_large = F.col("of.n_docs") * BROADCAST_SOURCES > counted.n_docs
    large = F.broadcast(of.where(is_large))
    others = rows.join(large, same, "left_anti").join(of.where(~is_large).hint("merge"), same)
    return rows.join(large, same).unionByName(others)


def _chosen_seed(seed: str) -> Column:
    """Of the seeds with the nearest sums below and above the target one, so that on average the
    target is met; from ``drawn``, the words that each seed's extra copies have."""
    whole = F.floor(F.col("of.rate")) * F.col("of.source_size")
    off = F.transform("drawn", lambda n, k: F.struct(((whole + n).cast("double") - F.col("of.target")).alias("off"), k.alias("k")))
    below = F.array_max(F.transform(F.filter(off, lambda o: o.off <= 0), lambda o: F.struct(o.off.alias("off"), (-o.k).alias("k"))))
    above = F.array_min(F.filter(off, lambda o: o.off > 0))
    coin = _hashes(F.col("of.source"), f"{seed}:source")[0].cast("double") / float(ONE)
    goes_up = coin < -below["off"] / (above["off"] - below["off"])
    return F.when(above.isNull(), -below["k"]).when(below.isNull(), above["k"]).when(goes_up, above["k"]).otherwise(-below["k"])


def sizes_and_rates(docs: DataFrame, staging: Staging, seed: str = SEED) -> tuple[DataFrame, DataFrame]:
    """doc_id, of_source, size and two hashes of each document, and the sources' rates and seeds.

    Texts are read once, for their sizes; sources and seeds follow from the narrow table.
    """
    size = F.size(words(text_or_empty("text"))).cast("long")
    first, second = _hashes(F.col("doc_id"), seed)
    narrow = docs.select(
        "doc_id", F.col("source").alias("of_source"), size.alias("size"), first.alias("first"), second.alias("second")
    )
    sized = staging.write(narrow, "sizes")
    targets = source_targets(sized.select(F.col("of_source").alias("source"), "size"), staging)
    rates = staging.write(targets, "rates")
    numbers = F.col("first"), F.col("second")
    drawn = [
        F.sum(F.when(_is_drawn(*numbers, k, F.col("of.rate")), F.col("size")).otherwise(0)).alias(f"drawn_{k}")
        for k in range(SEEDS)
    ]
    sums = _with_source(sized, rates).groupBy("of").agg(*drawn)
    sums = sums.select("of", F.array(*[f"drawn_{k}" for k in range(SEEDS)]).alias("drawn"))
    return sized, staging.write(sums.select("of.*", _chosen_seed(seed).cast("long").alias("seed")), "seeds")


def _repeats(first: Column, second: Column) -> Column:
    rate = F.col("of.rate")
    return F.floor(rate) + _is_drawn(first, second, F.col("of.seed"), rate).cast("long")


def report(docs: DataFrame, staging: Staging) -> DataFrame:
    sized, rates = sizes_and_rates(docs, staging)
    taken = F.col("size") * _repeats(F.col("first"), F.col("second"))
    return _with_source(sized, rates).select("doc_id", "size", "of.source_size", "of.target", taken.alias("taken"))


def repeated(docs: DataFrame, staging: Staging, seed: str = SEED) -> DataFrame:
    """Every document as often as the mix takes it, in the columns of ``docs``."""
    _, rates = sizes_and_rates(docs, staging, seed)
    rows = docs.select(F.struct("*").alias("doc"), F.col("source").alias("of_source"))
    repeats = _repeats(*_hashes(F.col("doc.doc_id"), seed))
    mixed = _with_source(rows, rates).select("doc", repeats.alias("repeats")).where("repeats > 0")
    return mixed.select("doc", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select("doc.*")


SQL_REPORT = r"""
WITH d AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> ''))::BIGINT AS size,
                  md5('mix-1:' || coalesce(doc_id::VARCHAR, 'null')) AS digest FROM documents),
h AS (SELECT doc_id, source, size, ('0x' || substr(digest, 1, 13))::BIGINT AS u, ('0x' || substr(digest, 14, 13))::BIGINT AS v FROM d),
s AS (SELECT source, sum(size)::BIGINT AS n, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (SELECT *, sum(n) OVER () - 3 * coalesce(sum(n) OVER (ORDER BY n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
             sum(w) OVER (ORDER BY n / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM s),
f AS (SELECT *, 3 * n * weights < w * room AS is_full FROM o),
l AS (SELECT room, weights FROM f WHERE NOT is_full ORDER BY weights DESC LIMIT 1),
t AS (SELECT source, n, CASE WHEN is_full THEN (3 * n)::DOUBLE ELSE (w * l.room)::DOUBLE / l.weights::DOUBLE END AS target FROM f, l),
r AS (SELECT *, CASE WHEN n > 0 THEN least(target / n, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
             ('0x' || substr(md5('mix-1:source:' || coalesce(source, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS coin FROM t),
k AS (SELECT r.source, k, (any_value(n) * floor(any_value(rate))::BIGINT + sum(CASE WHEN ((u + k * v) % 4503599627370496)::DOUBLE / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN size ELSE 0 END)::BIGINT)::DOUBLE - any_value(target) AS off
      FROM h JOIN r ON h.source IS NOT DISTINCT FROM r.source, range(64) AS seeds(k) GROUP BY r.source, k),
e AS (SELECT source, max(off) FILTER (off <= 0) AS lo, min(off) FILTER (off > 0) AS hi FROM k GROUP BY source),
c AS (SELECT k.source, min(k) FILTER (off = CASE WHEN hi IS NULL THEN lo WHEN lo IS NULL THEN hi WHEN coin < -lo / (hi - lo) THEN hi ELSE lo END) AS seed
      FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source JOIN r ON k.source IS NOT DISTINCT FROM r.source GROUP BY k.source)
SELECT doc_id, size, n AS source_size, target,
       (size * (floor(rate) + CASE WHEN ((u + seed * v) % 4503599627370496)::DOUBLE / 4503599627370496.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM h JOIN r ON h.source IS NOT DISTINCT FROM r.source JOIN c ON h.source IS NOT DISTINCT FROM c.source
"""
