"""Look-behind over ordered histories, for histories of any length.

Short histories use one window per key. A history too long for one task is given ``pieces``:
it is cut into ordered pieces wherever a task's share ends, be that within a day or an
instant, each piece is handled on its own, and a second window over one row per piece carries
the state from piece to piece.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxtrail.operators.skew import equi_join
from rxtrail.sources.staging import Staging


@dataclass(frozen=True)
class Pieces:
    """How long histories are cut: into pieces of about ``most_rows`` rows, stored by ``staging``."""

    staging: Staging
    most_rows: int

    def cut(self, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
        """Rows with a ``_piece``, which rises with ``order`` within each of ``keys``.

        Pieces are ranges of key and order, so each has about as many rows as the next whatever
        the keys. They are stored, as a range read again might be cut elsewhere. Rows that come
        with a ``_piece`` were cut by the same key and order; they are only stored.
        """
        rows = self.staging.write(rows, "long")
        if "_piece" in rows.columns:
            return rows
        n_pieces = max(2, -(-rows.count() // self.most_rows))
        ranged = rows.repartitionByRange(n_pieces, *_ordering([*keys, *order]))
        return self.staging.write(ranged.withColumn("_piece", F.spark_partition_id()), "pieces")


def _ordering(columns: Sequence[str]) -> list[Column]:
    return [F.col(column).asc_nulls_first() for column in columns]


def previous_value(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    pieces: Pieces | None = None,
) -> DataFrame:
    """Add ``value`` of the row just before, per key; no two rows of a key are alike in ``order``."""
    if pieces is None:
        history = Window.partitionBy(*keys).orderBy(*_ordering(order))
        return rows.withColumn(name, F.lag(value).over(history))
    rows = pieces.cut(rows, keys, order)
    piece = [*keys, "_piece"]
    last = rows.groupBy(*piece).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    earlier = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_piece"))
    carried = last.withColumn("_carried", earlier).drop("_last")
    in_piece = Window.partitionBy(*piece).orderBy(*_ordering(order))
    marked = rows.withColumn("_place", F.row_number().over(in_piece)).withColumn(
        name, F.lag(value).over(in_piece)
    )
    is_first = F.col("_place") == 1
    return (
        equi_join(marked, carried, piece, "left", null_safe=True)
        .withColumn(name, F.when(is_first, F.col("_carried")).otherwise(F.col(name)))
        .drop("_place", "_carried", "_piece")
    )


def _running(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    pieces: Pieces | None,
    last: int,
    combine: Callable[[str], Column],
    merge: Callable[[Column, Column], Column],
) -> DataFrame:
    """A running aggregate; rows that come cut into pieces stay cut."""
    frame = (Window.unboundedPreceding, last)
    given = rows.columns
    if pieces is None:
        history = Window.partitionBy(*keys).orderBy(*_ordering(order)).rowsBetween(*frame)
        return rows.withColumn(name, combine(value).over(history))
    rows = pieces.cut(rows, keys, order)
    piece = [*keys, "_piece"]
    pieces_before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(frame[0], -1)
    carried = (
        rows.groupBy(*piece)
        .agg(combine(value).alias("_of_piece"))
        .withColumn("_carried", combine("_of_piece").over(pieces_before))
        .drop("_of_piece")
    )
    in_piece = Window.partitionBy(*piece).orderBy(*_ordering(order)).rowsBetween(*frame)
    return (
        equi_join(
            rows.withColumn(name, combine(value).over(in_piece)), carried, piece, "left", null_safe=True
        )
        .withColumn(name, merge(F.col(name), F.col("_carried")))
        .select(*given, name)
    )


def running_total(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    pieces: Pieces | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over all rows up to this one, per key."""

    def merge(in_piece: Column, carried: Column) -> Column:
        return in_piece + F.coalesce(carried, F.lit(0))

    return _running(rows, keys, order, value, name, pieces, 0, F.sum, merge)


def running_max(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    pieces: Pieces | None = None,
    including_this: bool = True,
) -> DataFrame:
    """Add the greatest ``value`` of all rows before this one, and of this one if wanted."""
    last = 0 if including_this else -1
    return _running(rows, keys, order, value, name, pieces, last, F.max, F.greatest)
