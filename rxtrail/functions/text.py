"""Product-name comparisons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_product(name: Column, suffix: str) -> Column:
    """Product name without its injectable marker."""
    return F.replace(name, F.lit(suffix), F.lit(""))


def listing(names: Column) -> Column:
    """Sorted names joined by a comma; an empty array gives '' rather than NULL."""
    return F.array_join(F.sort_array(names), ", ")


def mentions(text: Column, name: Column) -> Column:
    """True if ``text`` holds ``name`` in any case; % and _ in the name are wildcards.
    A backslash stands for itself.

    A pattern that differs from row to row would be compiled for each, so none is used: names
    without wildcards are searched for as they are, others piece by piece.
    """
    text, name = F.lower(text), F.lower(name)
    is_plain = F.translate(name, "%_", "") == name
    return F.when(is_plain, F.contains(text, name)).otherwise(_holds_pieces(text, name))


def _holds_pieces(text: Column, name: Column) -> Column:
    """True if the pieces of ``name`` between its % follow each other in ``text``.

    A piece has one length, so to take each at its first place from the end of the last loses
    no match. The running value is where the next piece may start, or 0 after a failure.
    """

    def after(start: Column, piece: Column) -> Column:
        at = F.when(F.contains(piece, F.lit("_")), _first_fit(text, piece, start)).otherwise(
            F.position(piece, text, start)
        )
        return F.when((start == 0) | (at == 0), 0).otherwise(at + F.length(piece))

    pieces = F.filter(F.split(name, "%"), lambda piece: piece != "")
    return F.when(text.isNotNull(), F.aggregate(pieces, F.lit(1), after) > 0)


def _first_fit(text: Column, piece: Column, start: Column) -> Column:
    """The first place from ``start`` where ``piece`` fits, each _ on any character; or 0."""
    last = F.length(text) - F.length(piece) + 1

    def fits(at: Column) -> Column:
        def same(i: Column) -> Column:
            wanted = F.substr(piece, i, F.lit(1))
            return (wanted == "_") | (wanted == F.substr(text, at + i - 1, F.lit(1)))

        return F.forall(F.sequence(F.lit(1), F.length(piece)), same)

    places = F.when(last >= start, F.sequence(start, last)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.get(F.filter(places, fits), F.lit(0)), F.lit(0))
