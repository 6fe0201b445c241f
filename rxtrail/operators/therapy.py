"""What a purchase is for: its therapy rule, the patient's age, and the gate on both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.functions.dates import year_diff

ALTERNATIVE = "Alternative Therapies"

# Rule labels, in the order in which they apply, and their tags.
THERAPIES: list[tuple[str, str]] = [
    ("Pain Diet", "joint_diet"),
    ("DMOAD", "dmoad"),
    ("NSAIDs", "nsaid"),
    ("Supplements", "supplement"),
    ("Monoclonal Antibody", "mab"),
    ("Analgesic", "analgesic_tag"),
    ("Gabapentin & Tramadol", "gabapentin_tramadol"),
    ("Anti-Inflammatory", "anti_inflammatory"),
    ("Opiate", "opiate"),
    (ALTERNATIVE, "alternative_therapy"),
]

PAIN = tuple(name for _, name in THERAPIES)


def therapy_rule(config: ChronicConfig) -> Column:
    """Label of the first therapy the tag belongs to, else NULL."""
    (label, name), *others = THERAPIES
    chosen = F.when(config.member("tag", name), label)
    for label, name in others:
        chosen = chosen.when(config.member("tag", name), label)
    return chosen


def age_at(when: Column) -> Column:
    return year_diff(F.col("birth_date"), when)


def passes_gate(config: ChronicConfig) -> Column:
    """Alternative therapies need an old enough patient or enough validators."""
    return F.coalesce(
        (F.col("rule") != ALTERNATIVE)
        | (F.col("patient_age") >= config.min_age)
        | (F.col("validating_purchases") >= config.min_validators),
        F.lit(False),
    )


def alternative_therapy_gate(survivors: DataFrame, config: ChronicConfig) -> DataFrame:
    return survivors.where(passes_gate(config))
