"""Runs of purchases of one product, and how long each lasted.

An island starts where a patient buys a product that was not the previous purchase. Rows
of one patient, time, practice and product follow each other and only the first of them
can start an island, so islands are numbered on those groups ("steps") with row counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.operators.skew import HotKeys, lookup_join
from rxtrail.operators.switching import ITEM
from rxtrail.operators.timeline import Pieces, previous_value, running_max, running_total

STEP = ("patient_odu_id", "transaction_datetime", "practice_odu_id", "species", "product_name")
ISLAND = ("patient_odu_id", "island_id")
TIMES = ("previous_purchase", "last_purchase_of_product")


def n_rows() -> Column:
    """Rows of an item in the report: distinct purchases times previous drugs."""
    return F.col("n_purchases") * F.size("switches")


def purchase_steps(items: DataFrame) -> DataFrame:
    """Steps with their number of rows and their items, which differ in drug or brand only."""
    inside = F.struct(*[name for name in items.columns if name not in STEP])
    return items.groupBy(*STEP).agg(
        F.sum(n_rows()).alias("n_rows"), F.collect_list(inside).alias("items")
    )


def number_islands(steps: DataFrame, pieces: Pieces | None) -> DataFrame:
    """Add each step's previous purchase times, island, and the length of the one before."""
    time, patient = "transaction_datetime", ["patient_odu_id"]
    of_species = [*patient, "species"]
    rows = previous_value(
        steps,
        of_species,
        [time, "practice_odu_id", "product_name"],
        time,
        "previous_purchase",
        pieces,
    )
    rows = previous_value(
        rows,
        [*of_species, "product_name"],
        [time, "practice_odu_id"],
        time,
        "last_purchase_of_product",
        pieces,
    )
    goes_on = F.col("last_purchase_of_product") == F.col("previous_purchase")
    rows = rows.withColumn("starts", F.when(goes_on, 0).otherwise(1))

    order = [time, "practice_odu_id", "species", "product_name"]
    if pieces is not None:
        rows = pieces.cut(rows, patient, order)
    rows = running_total(rows, patient, order, "starts", "island_id", pieces)
    rows = running_total(rows, patient, order, "n_rows", "so_far", pieces)
    starts_after = F.when(F.col("starts") == 1, F.col("so_far") - F.col("n_rows"))
    rows = rows.withColumn("starts_after", starts_after)
    rows = running_max(
        rows, patient, order, "starts_after", "one_before", pieces, including_this=False
    )
    # Starts only grow, so the greatest is the latest.
    length = (F.col("starts_after") - F.col("one_before")).alias("length")
    left = F.when(F.col("starts") == 1, F.struct("starts_after", length))
    rows = running_max(rows.withColumn("left", left), patient, order, "left", "latest", pieces)
    return rows.withColumn("previous_purchases", F.col("latest.length")).drop(
        "_piece", "starts", "so_far", "starts_after", "one_before", "left", "latest"
    )


def items_on_islands(items: DataFrame, pieces: Pieces | None) -> DataFrame:
    steps = number_islands(purchase_steps(items), pieces)
    return steps.drop("n_rows").select("*", F.inline("items")).drop("items")


def island_lengths(items: DataFrame) -> DataFrame:
    return items.groupBy(*ISLAND).agg(F.sum(n_rows()).alias("previous_purchases"))


def rows_of_items(purchases: DataFrame, items: DataFrame, hot_items: HotKeys | None) -> DataFrame:
    """Distinct purchases with what is known of their item."""
    return lookup_join(purchases, items, ITEM, hot_items, null_safe=True)


def previous_times_of_rows(rows: DataFrame, hot_steps: HotKeys | None) -> DataFrame:
    """Give every row but the first of a step the step's own time as previous times."""
    first = ["drug", "is_brand_name", "revenue", "previous_drug"]
    rest = [c for c in rows.columns if c not in STEP and c not in first and c not in TIMES]
    place = F.struct(*first, *sorted(rest))
    firsts = rows.groupBy(*STEP).agg(F.min(place).alias("first_place"))
    marked = lookup_join(rows, firsts, STEP, hot_steps, null_safe=True)
    is_first = place == F.col("first_place")
    for time in TIMES:
        own = F.col("transaction_datetime")
        marked = marked.withColumn(time, F.when(is_first, F.col(time)).otherwise(own))
    return marked.drop("first_place")
