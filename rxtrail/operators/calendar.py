"""One row per patient and day: what happened around that day.

Lines are first reduced to patient-days by a partially aggregated group-by. A patient then
has at most as many rows as the input months have days, whatever the number of lines, and
the interval joins become RANGE frames over those few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.functions.dates import day_number, first_of_month, month_index
from rxtrail.operators.universe import PATIENT, dogs_and_cats

DAY = (*PATIENT, "event_date")

ILLNESS = (
    "dental_and_surgery",
    "urinalysis",
    "invalid_pain",
    "antibiotic",
    "antihistamine",
    "skin_topical",
    "steroid",
    "derm_steroid",
)

# Flag of a day -> (tags that set it, first and last day around the day that count).
NEARBY: dict[str, tuple[tuple[str, ...], int, int]] = {
    "illness_nearby": (ILLNESS, -7, 7),
    "procedure_or_antibiotic_nearby": (("dental_and_surgery", "antibiotic"), -7, 7),
    "urinalysis_nearby": (("urinalysis",), -14, 14),
    "exam_follows": (("exam",), 0, 14),
}

VALIDATORS = (
    "joint_diet",
    "analgesic",
    "dmoad",
    "nsaid_category",
    "supplement",
    "anti_inflammatory",
    "mab",
    "gabapentin_tramadol",
)


def event_date() -> Column:
    return F.to_date("transaction_datetime")


def counts_from(month: Column, seen_before: Column, config: ChronicConfig) -> Column:
    """First and last-but-one month a sighting adds to the validator count, as two changes.

    A purchase seen in month m counts for the months m .. m + look-back, but only once where
    it is seen in several months: then from where its previous sighting runs out. Summing
    the changes up to a month gives the distinct count for that month.
    """
    reach = config.lookback_months + 1

    def change(at: Column, step: int) -> Column:
        return F.struct(first_of_month(at).alias("event_date"), F.lit(step).alias("step"))

    return F.array(
        change(F.greatest(month, seen_before + reach), 1),
        change(month + reach, -1),
    )


def day_flags(config: ChronicConfig) -> dict[str, Column]:
    return {flag: config.member("tag", *tags) for flag, (tags, _, _) in NEARBY.items()}


def with_surroundings(days: DataFrame, *kept: str) -> DataFrame:
    """Widen the flags of each day to its surroundings, and total the validator changes."""
    history = Window.partitionBy(*PATIENT).orderBy("day")
    around = [
        F.coalesce(F.max(flag).over(history.rangeBetween(first, last)), F.lit(False)).alias(flag)
        for flag, (_, first, last) in NEARBY.items()
    ]
    so_far = F.sum("step").over(history.rangeBetween(Window.unboundedPreceding, 0))
    validators = F.coalesce(so_far, F.lit(0)).cast("long").alias("validators")
    return days.withColumn("day", day_number(F.col("event_date"))).select(
        *DAY, *kept, *around, validators
    )


def validator_sightings(tagged: DataFrame, config: ChronicConfig) -> DataFrame:
    """The months in which a patient's validator purchases were seen."""
    return (
        tagged.where(config.member("tag", *VALIDATORS) & F.col("transaction_odu_id").isNotNull())
        .select(*PATIENT, "transaction_odu_id", month_index(F.col("transaction_datetime")).alias("month"))
        .distinct()
    )


def validator_steps(sightings: DataFrame, config: ChronicConfig) -> DataFrame:
    """Per patient and month, the change in the number of validators within the look-back."""
    months = (
        sightings.groupBy(*PATIENT, "transaction_odu_id")
        .agg(F.collect_set("month").alias("months"))
        .withColumn("months", F.sort_array("months"))
    )

    def changes(month: Column, position: Column) -> Column:
        return counts_from(month, F.get("months", position - 1), config)

    return months.select(
        *PATIENT, F.inline(F.flatten(F.transform("months", changes)))
    )


def patient_calendar(
    events: DataFrame, sightings: DataFrame, patients: DataFrame, config: ChronicConfig
) -> DataFrame:
    """Days with lines of dogs and cats, with the flags and validator count of each day.

    ``events`` are days with their flags and whether they ``has_lines`` to be judged, in any
    number of rows a day.
    """
    days = (
        events.unionByName(validator_steps(sightings, config), allowMissingColumns=True)
        .groupBy(*DAY)
        .agg(
            *[F.max(flag).alias(flag) for flag in NEARBY],
            F.max("has_lines").alias("has_lines"),
            F.sum("step").alias("step"),
        )
    )
    return (
        with_surroundings(days, "has_lines")
        .where("has_lines")
        .drop("has_lines")
        .join(dogs_and_cats(patients), list(PATIENT))
    )
