"""Which purchase lines matter, and the one tag each of them gets."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.functions.dates import months_before
from rxtrail.operators.skew import dimension_join
from rxtrail.sources.relations import ChronicInputs
from rxtrail.sources.staging import Staging

PATIENT = ("server_odu_id", "patient_odu_id")
PRACTICE = ("server_odu_id", "practice_odu_id")
CATALOG_ITEM = ("catalog_source_server_odu_id", "catalog_odu_id")

LEAF, LEVEL_3 = "revenue_category_odu_id", "level_3_revenue_category_id"
LEVEL_2, TOP = "level_2_revenue_category_id", "top_revenue_category_id"

# A line is kept if any of its levels is in these sets, or its item has a wanted tag.
KEPT = {
    LEVEL_3: ("nsaid_category",),
    LEVEL_2: ("dmoad", "antibiotic", "steroid"),
    LEAF: (
        "analgesic",
        "gabapentin_tramadol",
        "supplement",
        "anti_inflammatory",
        "mab",
        "opiate",
        "alternative_therapy",
        "anesthesia_hospitalization",
        "invalid_pain",
        "antihistamine",
        "skin_topical",
        "derm_steroid",
        "exam",
    ),
    TOP: ("dental_and_surgery", "vaccine"),
}

# What the steps after the first filter read of a line.
LINE = (
    *PATIENT,
    "practice_odu_id",
    "transaction_datetime",
    "odu_updated_at_utc",
    "invoice_odu_id",
    "transaction_odu_id",
    *CATALOG_ITEM,
    *KEPT,
)

# The first level with a member gives the tag; a wanted catalog tag comes before all.
TAGGED = {
    LEAF: (
        "anesthesia_hospitalization",
        "exam",
        "analgesic_tag",
        "invalid_pain",
        "alternative_therapy",
        "anti_inflammatory",
        "antihistamine",
        "immunotherapy",
        "skin_topical",
        "opiate",
        "supplement",
        "derm_steroid",
        "mab",
        "gabapentin_tramadol",
    ),
    LEVEL_3: ("nsaid",),
    LEVEL_2: ("antibiotic", "dmoad", "steroid"),
    TOP: ("dental_and_surgery", "vaccine"),
}


def in_input_months(config: ChronicConfig) -> Column:
    when = F.col("transaction_datetime")
    return (when >= months_before(config.today(), config.input_months)) & (
        when < months_before(config.today(), 0)
    )


def recent_revenue_lines(
    transactions: DataFrame, config: ChronicConfig, when: Column | None = None
) -> DataFrame:
    """Revenue lines that were not declined, by default of the input months; all of it reaches the scan."""
    declined = F.col("description").ilike("%declined%")
    return transactions.where(
        (in_input_months(config) if when is None else when)
        & F.col("is_revenue")
        & (F.col("description").isNull() | ~declined)
    )


def whitelist(practice_info: DataFrame) -> DataFrame:
    listed = practice_info.where(
        (F.col("timeframe") == "Current Year") & (F.col("patient_type") == "Non Home Delivery")
    )
    return listed.select(*PRACTICE).distinct()


def at_whitelisted_practices(
    lines: DataFrame, practice_info: DataFrame, config: ChronicConfig, staging: Staging
) -> DataFrame:
    """Lines of practices listed for the current year without home delivery."""
    return dimension_join(
        lines,
        whitelist(practice_info),
        PRACTICE,
        config.skew,
        staging,
        how="left_semi",
    )


def wanted_tags(catalog_tags: DataFrame, config: ChronicConfig) -> DataFrame:
    return catalog_tags.where(F.col("catalog_tag_odu_id").isin(*config.ids("joint_diet", "urinalysis")))


def with_catalog_tags(
    lines: DataFrame, catalog_tags: DataFrame, config: ChronicConfig, staging: Staging
) -> DataFrame:
    """Add an item's joint-diet or urinalysis tag; an item with both gives two lines."""
    return dimension_join(
        lines,
        wanted_tags(catalog_tags, config).withColumnRenamed("odu_updated_at_utc", "tag_updated_at_utc"),
        CATALOG_ITEM,
        config.skew,
        staging,
    )


def is_relevant(config: ChronicConfig) -> Column:
    by_category = [config.member(level, *names) for level, names in KEPT.items()]
    return reduce(or_, by_category, F.col("catalog_tag_odu_id").isNotNull())


def tag(config: ChronicConfig) -> Column:
    """The tag of a line, NULL where no level gives one."""
    chosen = F.when(F.col("catalog_tag_odu_id").isNotNull(), F.col("catalog_tag_odu_id"))
    for level, names in TAGGED.items():
        chosen = chosen.when(config.member(level, *names), F.col(level))
    return chosen


def freshness() -> Column:
    own = F.col("odu_updated_at_utc")
    return F.greatest(own, F.coalesce(F.col("tag_updated_at_utc"), own))


def patients_with_news(
    inputs: ChronicInputs, is_fresh: Column, config: ChronicConfig, staging: Staging
) -> DataFrame:
    """At least the patients with a line, or with an item, that is stamped fresh.

    Lines are read by their own stamp, of which little is fresh, and in a few columns. Only if a
    tag is fresh too, all lines are looked through for its items.
    """
    lines = inputs.transactions.where(in_input_months(config))
    own = lines.where(is_fresh).select(*PATIENT)
    items = wanted_tags(inputs.catalog_tags, config).where(is_fresh).select(*CATALOG_ITEM).distinct()
    items = staging.write(items, "fresh_items")
    if items.isEmpty():
        return own
    lines = lines.select(*PATIENT, *CATALOG_ITEM)
    tagged = dimension_join(lines, items, CATALOG_ITEM, config.skew, staging, how="left_semi")
    return own.unionByName(tagged.select(*PATIENT))


def relevant_lines(
    inputs: ChronicInputs,
    config: ChronicConfig,
    staging: Staging,
    wanted: Column | None = None,
    when: Column | None = None,
) -> DataFrame:
    """The lines of any species that matter. With small dimensions, rows never move.

    The list of practices comes last, so that a large one moves relevant lines alone. ``wanted``
    is a condition on the columns of a line that is met at the scan, as is ``when``, by default
    the input months.
    """
    lines = recent_revenue_lines(inputs.transactions, config, when).select(*LINE)
    if wanted is not None:
        lines = lines.where(wanted)
    lines = with_catalog_tags(lines, inputs.catalog_tags, config, staging).where(is_relevant(config))
    return at_whitelisted_practices(lines, inputs.practice_info, config, staging)


def tagged_lines(lines: DataFrame, config: ChronicConfig) -> DataFrame:
    """Lines reduced to the columns the model goes on with."""
    return lines.select(
        *PATIENT,
        "practice_odu_id",
        "transaction_datetime",
        freshness().alias("odu_updated_at_utc"),
        "invoice_odu_id",
        "transaction_odu_id",
        tag(config).alias("tag"),
    )


def dogs_and_cats(patients: DataFrame) -> DataFrame:
    return patients.where(F.col("species").isin("canine", "feline")).select(
        *PATIENT, "species", "birth_date"
    )
