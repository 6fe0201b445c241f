"""Product and brand switches: each visit compared with the patient's previous one.

Purchases are reduced to items (one per visit and product) and visits (one per patient,
practice and time). A visit holds its items, which are no more than there are products, so
same-visit and previous-visit comparisons are made on small arrays, without self-joins.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.config import SwitchConfig
from rxtrail.functions.text import base_product, listing, mentions
from rxtrail.operators.timeline import Pieces, previous_value

VISIT = ("practice_odu_id", "patient_odu_id", "transaction_datetime")
ITEM = (*VISIT, "species", "product_name", "drug", "is_brand_name")


def chronic_nsaid_cohort(purchases: DataFrame, config: SwitchConfig) -> DataFrame:
    """Purchases of named products for the chosen kind of pain; unnamed or NULL ones go."""
    return purchases.where(
        (F.col("pain_type") == config.pain_type)
        & (F.col("category_name") == config.category_name)
        & ~F.col("product_name").isin(*config.unnamed_products)
    )


def purchase_items(purchases: DataFrame) -> DataFrame:
    """One row per visit and product, with the number of distinct purchases."""
    return purchases.groupBy(*ITEM).agg(F.count(F.lit(1)).alias("n_purchases"))


def other_names(names: Column, product: Column, config: SwitchConfig) -> Column:
    """Names of a visit that are another product, injectables aside."""
    own = base_product(product, config.injectable_suffix)
    return F.filter(names, lambda name: base_product(name, config.injectable_suffix) != own)


def visits(items: DataFrame, pieces: Pieces | None, config: SwitchConfig) -> DataFrame:
    """One row per visit: its items, and the time and items of the visit before.

    Each item comes with ``same_day_products``, the list of the other products. A visit
    without practice, patient or time equals no other row and so has neither.
    """
    item = F.struct(*[name for name in (*ITEM, "n_purchases") if name not in VISIT])
    is_known = reduce(and_, [F.col(key).isNotNull() for key in VISIT])
    names = F.array_distinct(F.transform("items", lambda item: item.product_name))

    def with_list(item: Column) -> Column:
        others = listing(other_names(F.col("names"), item.product_name, config))
        return item.withField("same_day_products", F.when(is_known, others).otherwise(""))

    described = (
        items.groupBy(*VISIT)
        .agg(F.collect_list(item).alias("items"))
        .withColumn("names", names)
        .select(*VISIT, F.transform("items", with_list).alias("items"))
        .withColumn("visit", F.struct(F.col("transaction_datetime").alias("time"), "items"))
    )
    keys, time = ["practice_odu_id", "patient_odu_id"], ["transaction_datetime"]
    compared = previous_value(described, keys, time, "visit", "previous", pieces)
    has_previous = is_known & F.col("previous.time").isNotNull()
    return compared.select(
        *VISIT,
        "items",
        F.when(has_previous, F.col("previous.time")).alias("previous_purchase_date"),
        F.when(has_previous, F.col("previous.items")).alias("previous_items"),
    )


def switched_from(config: SwitchConfig) -> Column:
    """Items of the previous visit that this one may have replaced.

    They are another product, and neither was bought together with the other.
    """
    product, suffix = F.col("product_name"), config.injectable_suffix
    base = base_product(product, suffix)

    def replaced(item: Column) -> Column:
        return (
            (base_product(item.product_name, suffix) != base)
            & ~mentions(F.col("same_day_products"), item.product_name)
            & ~mentions(item.same_day_products, product)
        )

    return F.filter("previous_items", replaced)


def switches() -> Column:
    """One entry per previous drug, or a single one without; flags are never NULL."""
    drug = F.col("drug")

    def entry(previous: Column) -> Column:
        def was_brand(item: Column) -> Column:
            return item.drug.eqNullSafe(previous) & item.is_brand_name

        left_brand = (previous == drug) & F.exists("replaced", was_brand)
        return F.struct(
            previous.alias("previous_drug"),
            F.coalesce(previous != drug, F.lit(False)).alias("switch_yn"),
            F.coalesce(left_brand, F.lit(False)).alias("brand_name_switch_yn"),
        )

    drugs = F.array_distinct(F.transform("replaced", lambda item: item.drug))
    found = F.coalesce(F.size("replaced"), F.lit(0)) > 0
    return F.transform(F.when(found, drugs).otherwise(F.array(F.lit(None).cast("string"))), entry)


def switched_items(
    purchases: DataFrame, pieces: Pieces | None, config: SwitchConfig
) -> DataFrame:
    """Items with what was bought with them, the time before, and their switches."""
    seen = visits(purchase_items(purchases), pieces, config)
    return (
        seen.select(*VISIT, "previous_purchase_date", "previous_items", F.inline("items"))
        .withColumn("replaced", switched_from(config))
        .withColumn("switches", switches())
        .drop("previous_items", "replaced")
    )
