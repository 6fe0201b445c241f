"""Purchases explained by something else: on the same invoice, or close in time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.functions.dates import month_index
from rxtrail.operators.calendar import (
    DAY,
    NEARBY,
    VALIDATORS,
    counts_from,
    day_flags,
    event_date,
    patient_calendar,
    validator_sightings,
    with_surroundings,
)
from rxtrail.operators.skew import HotKeys, find_hot_keys, lookup_join
from rxtrail.operators.therapy import PAIN, age_at, therapy_rule
from rxtrail.operators.universe import PATIENT, dogs_and_cats
from rxtrail.sources.staging import Staging

INVOICE = (*PATIENT, "invoice_odu_id")
PURCHASE = (*PATIENT, "transaction_odu_id")

# Flag of an invoice -> tags that set it.
ON_INVOICE: dict[str, tuple[str, ...]] = {
    "anesthesia_on_invoice": ("anesthesia_hospitalization",),
    "vaccine_on_invoice": ("vaccine",),
    "invalid_pain_on_invoice": ("invalid_pain",),
    "immunotherapy_on_invoice": ("immunotherapy",),
    "calming_on_invoice": ("anticonvulsant", "antidepressant", "sedative"),
}

# (purchased tags, flags of the invoice that explain the purchase)
INVOICE_RULES: list[tuple[tuple[str, ...], tuple[str, ...]]] = [
    (("nsaid", "anti_inflammatory"), ("anesthesia_on_invoice", "vaccine_on_invoice")),
    (("supplement",), ("invalid_pain_on_invoice", "immunotherapy_on_invoice")),
    (("analgesic",), ("anesthesia_on_invoice", "vaccine_on_invoice")),
    (("gabapentin_tramadol",), ("anesthesia_on_invoice", "calming_on_invoice")),
    (("opiate",), ("anesthesia_on_invoice",)),
    (("alternative_therapy",), ("anesthesia_on_invoice",)),
]

# (purchased tags, flag of the day that explains the purchase, species or any)
NEARBY_RULES: list[tuple[tuple[str, ...], str, str | None]] = [
    (("nsaid", "anti_inflammatory"), "illness_nearby", None),
    (("analgesic", "gabapentin_tramadol"), "illness_nearby", None),
    (("analgesic", "gabapentin_tramadol"), "exam_follows", None),
    (("opiate",), "procedure_or_antibiotic_nearby", None),
    (("opiate",), "urinalysis_nearby", "canine"),
    (("alternative_therapy",), "illness_nearby", None),
]


def invoice_flags(
    tagged: DataFrame, config: ChronicConfig, keys: Sequence[str] = INVOICE
) -> DataFrame:
    """Invoices holding anything that can explain a purchase on them."""
    named = sorted({name for names in ON_INVOICE.values() for name in names})
    return (
        tagged.where(config.member("tag", *named) & F.col("invoice_odu_id").isNotNull())
        .groupBy(*keys)
        .agg(*[F.max(config.member("tag", *tags)).alias(f) for f, tags in ON_INVOICE.items()])
    )


def explained_by_invoice(config: ChronicConfig) -> Column:
    hits = [
        config.member("tag", *tags) & F.coalesce(F.col(flag), F.lit(False))
        for tags, flags in INVOICE_RULES
        for flag in flags
    ]
    return reduce(or_, hits)


def explained_nearby(config: ChronicConfig) -> Column:
    hits = []
    for tags, flag, species in NEARBY_RULES:
        hit = config.member("tag", *tags) & F.col(flag)
        hits.append(hit if species is None else hit & (F.col("species") == species))
    return reduce(or_, hits)


def is_judged(config: ChronicConfig) -> Column:
    """Lines that are pain purchases, or that a rule can explain."""
    explainable = [name for tags, _ in INVOICE_RULES for name in tags]
    return config.member("tag", *PAIN, *explainable)


def judged_columns(config: ChronicConfig) -> list[Column | str]:
    alternative = config.member("tag", "alternative_therapy")
    return [
        *PATIENT,
        "practice_odu_id",
        "species",
        "birth_date",
        age_at(F.col("transaction_datetime")).alias("patient_age"),
        "transaction_odu_id",
        "transaction_datetime",
        "event_date",
        "odu_updated_at_utc",
        "invoice_odu_id",
        "tag",
        therapy_rule(config).alias("rule"),
        F.when(alternative, F.col("validators")).otherwise(0).alias("validating_purchases"),
        explained_by_invoice(config).alias("by_invoice"),
        explained_nearby(config).alias("nearby"),
    ]


def judged_in_place(tagged: DataFrame, patients: DataFrame, config: ChronicConfig) -> DataFrame:
    """Judged purchases of patients that fit a task, after a single shuffle by patient.

    Lines are grouped by day with the judged ones inside, the frames run over the days, and
    the lines come out again with what happened around them.
    """
    lines = tagged.repartition(*PATIENT).select(
        "*",
        event_date().alias("event_date"),
        month_index(F.col("transaction_datetime")).alias("month"),
        is_judged(config).alias("is_judged"),
        config.member("tag", *VALIDATORS).alias("is_validator"),
    )
    on_invoice = Window.partitionBy(*INVOICE)
    sightings = Window.partitionBy(*PURCHASE, "is_validator").orderBy("month")
    has_invoice = F.col("invoice_odu_id").isNotNull()
    lines = lines.select(
        "*",
        *[
            (F.max(config.member("tag", *tags)).over(on_invoice) & has_invoice).alias(flag)
            for flag, tags in ON_INVOICE.items()
        ],
    ).withColumn("seen_before", F.lag("month").over(sightings))

    is_sighting = (
        F.col("is_validator")
        & F.col("transaction_odu_id").isNotNull()
        & ~F.col("month").eqNullSafe(F.col("seen_before"))
    )
    own = F.struct("event_date", F.lit(None).cast("int").alias("step"))
    changes = counts_from(F.col("month"), F.col("seen_before"), config)
    moments = F.when(is_sighting, F.concat(F.array(own), changes)).otherwise(F.array(own))
    inside = F.struct(
        *[c for c in tagged.columns if c not in PATIENT],
        *ON_INVOICE,
    )
    of_line = F.col("step").isNull()
    days = (
        lines.withColumns(day_flags(config))
        .withColumn("line", F.when(F.col("is_judged"), inside))
        .select(*PATIENT, *NEARBY, "line", F.inline(moments.alias("moments")))
        .groupBy(*DAY)
        .agg(
            *[F.max(of_line & F.col(flag)).alias(flag) for flag in NEARBY],
            F.sum("step").alias("step"),
            F.collect_list(F.when(of_line, F.col("line"))).alias("lines"),
        )
    )
    judged = (
        with_surroundings(days, "lines")
        .where(F.size("lines") > 0)
        .join(dogs_and_cats(patients), list(PATIENT))
        .select("*", F.inline("lines"))
        .select(*judged_columns(config))
    )
    rows = Window.partitionBy(*PURCHASE)
    has_id = F.col("transaction_odu_id").isNotNull()
    dates = [found("event_date").over(rows) for found in (F.min, F.max)]
    return judged.select(
        "*",
        (has_id & F.max(F.col("by_invoice") | F.col("nearby")).over(rows)).alias("is_explained"),
        (has_id & (dates[0] != dates[1])).alias("several_dates"),
    )


def judged_by_lookup(
    tagged: DataFrame,
    patients: DataFrame,
    hot_patients: HotKeys,
    config: ChronicConfig,
    staging: Staging,
) -> DataFrame:
    """Judged purchases of patients of any size: lookups dealt over many tasks."""
    tagged = staging.write(tagged.distinct(), "tagged_of_hot")
    flags = [column.alias(flag) for flag, column in day_flags(config).items()]
    events = tagged.select(*PATIENT, event_date().alias("event_date"), *flags, F.lit(True).alias("has_lines"))
    calendar = patient_calendar(events, validator_sightings(tagged, config), patients, config)
    rows = tagged.where(is_judged(config)).withColumn("event_date", event_date())
    return judged_beside(rows, calendar, invoice_flags(tagged, config), hot_patients, config, staging)


def judged_beside(
    rows: DataFrame,
    calendar: DataFrame,
    invoices: DataFrame,
    hot_patients: HotKeys | None,
    config: ChronicConfig,
    staging: Staging,
) -> DataFrame:
    """Lines to be judged, by what their days and invoices hold."""
    days = staging.write(calendar, "calendar")
    # An invoice is one patient's, so only hot patients can have hot ones.
    hot_invoices = hot_patients and find_hot_keys(rows, INVOICE, config.skew, staging)
    rows = lookup_join(rows, days, DAY, hot_patients, how="inner")
    rows = lookup_join(rows, invoices, INVOICE, hot_invoices)
    judged = staging.write(rows.select(*judged_columns(config)), "judged_by_lookup")

    verdicts = judged.groupBy(*PURCHASE).agg(
        F.max(F.col("by_invoice") | F.col("nearby")).alias("is_explained"),
        (F.min("event_date") != F.max("event_date")).alias("several_dates"),
    )
    hot_purchases = find_hot_keys(judged, PURCHASE, config.skew, staging)
    return lookup_join(
        judged, verdicts.where("is_explained OR several_dates"), PURCHASE, hot_purchases
    ).fillna(False, ["is_explained", "several_dates"])


def surviving_purchases(judged: DataFrame, config: ChronicConfig) -> DataFrame:
    """Pain purchases without an explained row; one such row takes all rows with it."""
    return judged.where(config.member("tag", *PAIN) & ~F.col("is_explained"))
