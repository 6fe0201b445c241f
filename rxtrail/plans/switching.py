"""The product-switching model, stage by stage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtrail.config import SwitchConfig
from rxtrail.operators import islands, switching
from rxtrail.operators.skew import HotKeys, find_hot_keys, per_key, shuffled_by
from rxtrail.operators.timeline import Pieces
from rxtrail.sources.relations import RELATIONS
from rxtrail.sources.staging import Staging

COLUMNS = RELATIONS["syndicated_pain_all_pain_purchases"].names
PATIENT = ["patient_odu_id"]


class SwitchModel:
    """Stages of one run. Each is built when first asked for, those read twice are staged."""

    def __init__(self, purchases: DataFrame, config: SwitchConfig, staging: Staging):
        self.input = purchases
        self.config = config
        self.staging = staging

    def chronic_nsaid_cohort(self) -> DataFrame:
        return switching.chronic_nsaid_cohort(self.input, self.config)

    @cached_property
    def purchases(self) -> DataFrame:
        """The cohort without copies."""
        return self.staging.write(self.chronic_nsaid_cohort().distinct(), "purchases")

    @cached_property
    def hot_patients(self) -> HotKeys | None:
        return find_hot_keys(self.purchases, PATIENT, self.config.skew, self.staging)

    def hot(self, keys: Sequence[str]) -> HotKeys | None:
        """Hot keys that include the patient; only hot patients can have any."""
        return self.hot_patients and find_hot_keys(
            self.hot_patients.within(self.purchases), keys, self.config.skew, self.staging
        )

    def _switched(self, purchases: DataFrame, pieces: Pieces | None) -> DataFrame:
        return switching.switched_items(purchases, pieces, self.config)

    def _on_islands(self, purchases: DataFrame, pieces: Pieces | None) -> DataFrame:
        items = self._switched(purchases, pieces).drop("same_day_products")
        if pieces is not None:
            items = pieces.staging.write(items, "switched")
        return islands.items_on_islands(items, pieces)

    def _per_patient(self, work) -> DataFrame:
        """Work on the purchases' items; one shuffle by patient serves all that ``work`` does.

        Its tasks hold a bounded number of purchases, whatever the size of the input. Only
        patients too long for a task go piece by piece, with shuffles of their own.
        """
        n_rows = self.purchases.count()

        def prepared(rows: DataFrame, is_hot: bool) -> DataFrame:
            if is_hot:
                return work(rows, Pieces(self.staging, self.config.skew.hot_rows))
            return work(shuffled_by(rows, PATIENT, n_rows, self.config.skew), None)

        return per_key(self.purchases.select(*switching.ITEM), self.hot_patients, prepared)

    def _rows(self, items: DataFrame, *names: str) -> DataFrame:
        items = items.select(*switching.ITEM, *names)
        return islands.rows_of_items(self.purchases, items, self.hot(switching.ITEM))

    def same_day_combos(self) -> DataFrame:
        items = self._per_patient(self._switched)
        return self._rows(items, "same_day_products").select(*COLUMNS, "same_day_products")

    def previous_purchase_date(self) -> DataFrame:
        items = self._per_patient(self._switched)
        return self._rows(items, "previous_purchase_date").select(
            *COLUMNS, "previous_purchase_date"
        )

    def switch_pairs(self) -> DataFrame:
        items = self._per_patient(self._switched)
        return self._rows(items, "switches").select(*COLUMNS, F.inline("switches"))

    def product_islands(self) -> DataFrame:
        known = [*islands.TIMES, "island_id"]
        items = self._per_patient(self._on_islands)
        rows = self._rows(items, "switches", *known).select(
            *COLUMNS, F.inline("switches"), *known
        )
        rows = self.staging.write(rows, "rows_on_islands")
        return islands.previous_times_of_rows(rows, self.hot(islands.STEP))

    def island_lengths(self) -> DataFrame:
        return islands.island_lengths(self._per_patient(self._on_islands))

    def nsaid_switching(self, ordered: bool = True) -> DataFrame:
        """Every purchase with its flags, and how often the product left was bought."""
        items = self._per_patient(self._on_islands)
        rows = self._rows(items, "switches", "previous_purchases").select(
            *COLUMNS, F.inline("switches"), "previous_purchases"
        )
        switched = F.col("switch_yn") | F.col("brand_name_switch_yn")
        rows = rows.withColumn("previous_purchases", F.when(switched, F.col("previous_purchases")))
        if not ordered:
            return rows
        # The columns after the first two only let the sort split a busy visit.
        order = ["patient_odu_id", "transaction_datetime", "product_name", "revenue"]
        return rows.orderBy(*[F.col(column).asc_nulls_first() for column in order])
