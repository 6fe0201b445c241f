"""The chronic-purchase model, stage by stage."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.config import ChronicConfig
from rxtrail.operators import invalidation, repeats, therapy, universe
from rxtrail.operators.bloom import may_be_among
from rxtrail.operators.skew import HotKeys, find_hot_keys, lookup_join, per_key
from rxtrail.sources.relations import ChronicInputs
from rxtrail.sources.staging import Staging

PURCHASE = [*invalidation.PURCHASE]


class ChronicModel:
    """Stages of one run. Each is built when first asked for, those read twice are staged."""

    def __init__(
        self,
        inputs: ChronicInputs,
        config: ChronicConfig,
        staging: Staging,
        only_patients_with: Column | None = None,
    ):
        """``only_patients_with``, a condition on ``odu_updated_at_utc``, leaves out patients
        of whose lines, and tags of lines, none meets it."""
        self.inputs = inputs
        self.config = config
        self.staging = staging
        self.only_patients_with = only_patients_with

    # --- lines -----------------------------------------------------------------------

    def practice_whitelist(self) -> DataFrame:
        """Distinct lines of whitelisted practices."""
        lines = self.inputs.transactions.select(*PURCHASE, "practice_odu_id")
        return universe.at_whitelisted_practices(
            lines, self.inputs.practice_info, self.config, self.staging
        ).distinct()

    def tag_assignment(self) -> DataFrame:
        """Distinct lines with their tag."""
        lines = self.inputs.transactions.select(*universe.LINE)
        lines = universe.with_catalog_tags(
            lines, self.inputs.catalog_tags, self.config, self.staging
        )
        tagged = universe.tagged_lines(lines, self.config)
        return tagged.select(*PURCHASE, "tag", "odu_updated_at_utc").distinct()

    def _of_dogs_and_cats(self, lines: DataFrame, hot_patients: HotKeys | None) -> DataFrame:
        return lookup_join(
            lines,
            universe.dogs_and_cats(self.inputs.patients),
            universe.PATIENT,
            hot_patients,
            how="inner",
        )

    def _find_hot_patients(self, lines: DataFrame) -> HotKeys | None:
        return find_hot_keys(lines, universe.PATIENT, self.config.skew, self.staging)

    def pain_universe(self) -> DataFrame:
        """Distinct relevant lines of dogs and cats."""
        lines = universe.relevant_lines(self.inputs, self.config, self.staging).select(
            *PURCHASE,
            "practice_odu_id",
            "transaction_datetime",
            "catalog_tag_odu_id",
            *universe.TAGGED,
        )
        lines = self.staging.write(lines.distinct(), "universe")
        rows = self._of_dogs_and_cats(lines, self._find_hot_patients(lines))
        return rows.drop("birth_date").distinct()

    @cached_property
    def tagged(self) -> DataFrame:
        """Relevant lines with their tags, copies included; no step below minds copies."""
        lines = universe.relevant_lines(self.inputs, self.config, self.staging, self._may_be_wanted())
        return self.staging.write(universe.tagged_lines(lines, self.config), "tagged")

    def _may_be_wanted(self) -> Column | None:
        """Of lines in the scan, whether their patient is wanted; a few others pass."""
        if self.only_patients_with is None:
            return None
        patients = universe.patients_with_news(
            self.inputs, self.only_patients_with, self.config, self.staging
        )
        return may_be_among(patients, universe.PATIENT, self.staging)

    @cached_property
    def hot_patients(self) -> HotKeys | None:
        return self._find_hot_patients(self.tagged)

    def tagged_events(self) -> DataFrame:
        return self._of_dogs_and_cats(self.tagged, self.hot_patients).distinct()

    # --- invalidation ----------------------------------------------------------------

    def _lines_to_judge(self) -> DataFrame:
        """All lines, or all lines of patients with a tagged line of the wanted kind."""
        if self.only_patients_with is None:
            return self.tagged
        wanted = self.tagged.where(self.only_patients_with).select(*universe.PATIENT).distinct()
        return lookup_join(
            self.tagged, wanted, universe.PATIENT, self.hot_patients, how="left_semi"
        )

    @cached_property
    def judged(self) -> DataFrame:
        def judge(lines: DataFrame, is_hot: bool) -> DataFrame:
            if is_hot:
                return invalidation.judged_by_lookup(
                    lines, self.inputs.patients, self.hot_patients, self.config, self.staging
                )
            return invalidation.judged_in_place(lines, self.inputs.patients, self.config)

        judged = per_key(self._lines_to_judge(), self.hot_patients, judge)
        return self.staging.write(judged, "judged")

    def invalid_by_invoice(self) -> DataFrame:
        return self.judged.where("by_invoice").select(*PURCHASE).distinct()

    def invalid_by_window(self) -> DataFrame:
        return self.judged.where("nearby").select(*PURCHASE).distinct()

    def invalid_purchases(self) -> DataFrame:
        return self.judged.where("by_invoice OR nearby").select(*PURCHASE).distinct()

    # --- therapies -------------------------------------------------------------------

    def ungated(self) -> DataFrame:
        return invalidation.surviving_purchases(self.judged, self.config)

    def survivors(self) -> DataFrame:
        return therapy.alternative_therapy_gate(self.ungated(), self.config).select(
            *universe.PATIENT,
            "practice_odu_id",
            "species",
            "transaction_odu_id",
            "transaction_datetime",
            "event_date",
            "odu_updated_at_utc",
            "invoice_odu_id",
            "rule",
            "several_dates",
        )

    def surviving_purchases(self) -> DataFrame:
        return (
            self.ungated()
            .select(*PURCHASE, "practice_odu_id", "species", "transaction_datetime", "tag")
            .distinct()
        )

    def therapy_rule(self) -> DataFrame:
        pain = self.judged.where(F.col("rule").isNotNull())
        return pain.select(*PURCHASE, "tag", "rule").distinct()

    def age_at_event(self) -> DataFrame:
        """Age at every pain purchase."""
        return self.judged.where(F.col("rule").isNotNull()).select(
            *PURCHASE, "transaction_datetime", "birth_date", "patient_age"
        ).distinct()

    def _pain_purchases(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(
            *universe.PATIENT,
            "practice_odu_id",
            "patient_age",
            "species",
            "transaction_odu_id",
            "transaction_datetime",
            "odu_updated_at_utc",
            "invoice_odu_id",
            "rule",
        ).agg(F.max("validating_purchases").alias("validating_purchases"))

    def corroboration_count(self) -> DataFrame:
        return self._pain_purchases(self.ungated())

    def alt_therapy_gate(self) -> DataFrame:
        return self._pain_purchases(
            therapy.alternative_therapy_gate(self.ungated(), self.config)
        )

    # --- chronicity ------------------------------------------------------------------

    def repeats(self) -> DataFrame:
        return repeats.with_repeats(self.survivors(), self.hot_patients, self.config, self.staging)

    def repeat_purchases(self) -> DataFrame:
        return (
            self.repeats()
            .select(*PURCHASE, "transaction_datetime", "rule", "purchases")
            .distinct()
        )

    def freshness_stamp(self) -> DataFrame:
        stamp = repeats.newest(
            F.col("odu_updated_at_utc"), F.col("updated_at"), self.config.null_stamps_win
        )
        return (
            self.repeats()
            .select(*PURCHASE, "rule", "odu_updated_at_utc", "updated_at", stamp.alias("newest_at"))
            .distinct()
        )

    def chronic_purchases(self) -> DataFrame:
        return repeats.chronic_purchases(self.repeats(), self.config)
