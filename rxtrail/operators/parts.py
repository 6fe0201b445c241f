"""What is kept of tagged lines so that later lines can be added: four partial aggregates.

| part | row | holds |
| --- | --- | --- |
| purchases | line to be judged | all its columns, once |
| days | patient and day | which tags around a purchase matter |
| sightings | validator purchase and month | nothing else |
| invoices | invoice and month | which tags on a purchase's invoice matter |

Each is a set, or a maximum of flags by key, so parts of any lots of lines, in any order and with
lines in common, merge to the parts of all these lines. Every row belongs to one month, so input
months cut parts exactly as they cut lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.functions.dates import month_index, months_before
from rxtrail.operators.calendar import DAY, NEARBY, day_flags, event_date, patient_calendar, validator_sightings
from rxtrail.operators.invalidation import INVOICE, PURCHASE, invoice_flags, is_judged, judged_beside
from rxtrail.operators.skew import HotKeys
from rxtrail.operators.universe import PATIENT
from rxtrail.sources.staging import Staging

Parts = dict[str, DataFrame]

#: Of each part, the key of its flags; those without flags are sets.
KEYS: dict[str, tuple[str, ...] | None] = {
    "purchases": None,
    "days": DAY,
    "sightings": (*PURCHASE, "month"),
    "invoices": (*INVOICE, "month"),
}


def parts_of(tagged: DataFrame, config: ChronicConfig) -> Parts:
    """The parts of some tagged lines."""
    flags = day_flags(config)
    days = tagged.select(
        *PATIENT, event_date().alias("event_date"), *[column.alias(flag) for flag, column in flags.items()]
    ).where(" OR ".join(flags))
    by_month = tagged.withColumn("month", month_index(F.col("transaction_datetime")))
    return {
        "purchases": tagged.where(is_judged(config)).distinct(),
        "days": _merged("days", days),
        "sightings": validator_sightings(tagged, config),
        "invoices": invoice_flags(by_month, config, KEYS["invoices"]),
    }


def _merged(part: str, rows: DataFrame) -> DataFrame:
    keys = KEYS[part]
    flags = [c for c in rows.columns if keys and c not in keys]
    return rows.groupBy(*keys).agg(*[F.max(flag).alias(flag) for flag in flags]) if flags else rows.distinct()


def merged(*lots: Parts) -> Parts:
    """The parts of all lots together."""
    result = {}
    for part in KEYS:
        first, *others = [lot[part] for lot in lots]
        for other in others:
            first = first.unionByName(other)
        result[part] = _merged(part, first)
    return result


def of_input_months(parts: Parts, config: ChronicConfig, to_last: bool = True) -> Parts:
    """The parts that lines of the input months alone would give, or lines from the first on."""
    first, last = months_before(config.today(), config.input_months), months_before(config.today(), 0)

    def within(when: Column, bound: Callable[[Column], Column]) -> Column:
        return (when >= bound(first)) & (when < bound(last) if to_last else F.lit(True))

    conditions = {
        "purchases": within(F.col("transaction_datetime"), lambda at: at),
        "days": within(F.col("event_date"), lambda at: at.cast("date")),
        "sightings": within(F.col("month"), month_index),
        "invoices": within(F.col("month"), month_index),
    }
    return {part: rows.where(conditions[part]) for part, rows in parts.items()}


def judged_from_parts(
    parts: Parts,
    patients: DataFrame,
    hot_patients: HotKeys | None,
    config: ChronicConfig,
    staging: Staging,
) -> DataFrame:
    """Judged purchases, as the lines themselves give them."""
    rows = parts["purchases"].withColumn("event_date", event_date())
    to_judge = rows.select(*DAY, *[F.lit(None).cast("boolean").alias(f) for f in NEARBY], F.lit(True).alias("has_lines"))
    around = parts["days"].select(*DAY, *NEARBY, F.lit(None).cast("boolean").alias("has_lines"))
    calendar = patient_calendar(to_judge.unionByName(around), parts["sightings"], patients, config)
    flags = [c for c in parts["invoices"].columns if c not in KEYS["invoices"]]
    invoices = parts["invoices"].groupBy(*INVOICE).agg(*[F.max(flag).alias(flag) for flag in flags])
    return judged_beside(rows, calendar, invoices, hot_patients, config, staging)
