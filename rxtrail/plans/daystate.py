"""The chronic model over a stored state that grows with the lines, instead of over all lines.

Lines that are older by their stamp than the newest one less the overlap are *settled*: they are
read once, reduced to parts (`operators/parts.py`) and stored. Later lines are the *tail*, read
from the source whenever the state is used. The state's parts and the tail's merge to those of all
lines, so the model gives the same rows as over the lines themselves.

That holds as long as settled lines and dimensions stay what they were. Both are looked at before
the state is used: settled lines by their number and a sum and a combination of their hashes,
over a few columns and without a shuffle. A line that was updated, removed or came late, another
tag, practice or category set, or input months that start earlier make a new state from all lines.
"""

from __future__ import annotations

import hashlib
from functools import cached_property, reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtrail.config import FIXED_IDS, ChronicConfig
from rxtrail.functions.dates import months_before
from rxtrail.operators import universe
from rxtrail.operators.bloom import may_be_among
from rxtrail.operators.parts import KEYS, Parts, judged_from_parts, merged, of_input_months, parts_of
from rxtrail.operators.skew import HotKeys
from rxtrail.plans.chronic import ChronicModel
from rxtrail.sources.relations import ChronicInputs
from rxtrail.sources.staging import Staging
from rxtrail.sources.versions import Versions

IDENTITY = (*universe.PATIENT, "transaction_odu_id", "odu_updated_at_utc")
#: Of a hash, so that a sum of 2^38 of them is a long.
SUMMED_BITS = 24


def _hashes(row: Column) -> list[Column]:
    """Number, sum and combination of row hashes: equal for equal rows in any order."""
    return [
        F.count(row),
        F.coalesce(F.sum(F.pmod(row, F.lit(1 << SUMMED_BITS))), F.lit(0)),
        F.coalesce(F.bit_xor(row), F.lit(0)),
    ]


def _fingerprint(rows: DataFrame) -> list[int]:
    return list(rows.agg(*_hashes(F.xxhash64(*rows.columns))).first())


def _of_both(some: list[int], others: list[int]) -> list[int]:
    """The fingerprint of rows and other rows together."""
    return [some[0] + others[0], some[1] + others[1], some[2] ^ others[2]]


def _time(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _is_settled(until: str | None) -> Column:
    """Lines with a stamp before ``until``; those without a stamp from the start."""
    stamp = F.col("odu_updated_at_utc")
    return stamp.isNull() if until is None else stamp.isNull() | (stamp < _time(until))


def _is_dated_from(start: str) -> Column:
    return F.col("transaction_datetime") >= _time(start)


class DayState(Versions):
    """The stored parts of settled lines: one folder per lot, and a version that names the lots."""

    def folders(self, version: int) -> set[str]:
        return {lot.split("/")[1] for lot in self.content(version).get("lots", [])}

    # --- what a version holds ----------------------------------------------------------

    @staticmethod
    def _look(
        transactions: DataFrame, start: str, until: str | None, config: ChronicConfig
    ) -> tuple[list[int], str | None]:
        """The fingerprint of settled lines, and the stamp up to which lines are settled by now."""
        overlap = F.make_dt_interval(hours=F.lit(config.overlap_hours))
        newest = (F.max("odu_updated_at_utc") - overlap).cast("string")
        row = F.when(_is_settled(until), F.xxhash64(*IDENTITY))
        *settled, now_until = transactions.where(_is_dated_from(start)).agg(*_hashes(row), newest).first()
        return settled, now_until

    @staticmethod
    def _surroundings(inputs: ChronicInputs, config: ChronicConfig) -> list:
        """What else the parts follow from: dimensions and category sets."""
        sets = {name: sorted(ids) for name, ids in [*FIXED_IDS.items(), *config.sets.items()]}
        named = hashlib.sha256(repr(sorted(sets.items())).encode()).hexdigest()
        tags = universe.wanted_tags(inputs.catalog_tags, config).select(
            *universe.CATALOG_ITEM, "catalog_tag_odu_id", "odu_updated_at_utc"
        )
        return [named, _fingerprint(tags.distinct()), _fingerprint(universe.whitelist(inputs.practice_info))]

    def _start(self, config: ChronicConfig) -> str:
        start = self.spark.range(1).select(months_before(config.today(), config.input_months).cast("string"))
        return start.first()[0]

    def _if_it_fits(
        self, start: str, surroundings: list, inputs: ChronicInputs, config: ChronicConfig
    ) -> tuple[dict[str, Any], str | None]:
        """The current version if it stands for the settled lines as they are now, else nothing; in
        one pass, the stamp up to which lines are settled by now."""
        now = self.content()
        if not now or start < now["whole_from"] or surroundings != now["surroundings"]:
            return {}, None
        settled, until = self._look(inputs.transactions, now["start"], now["until"], config)
        return (now, until) if settled == now["settled"] else ({}, None)

    def fits(self, inputs: ChronicInputs, config: ChronicConfig) -> bool:
        """Whether the current version stands for the settled lines as they are now."""
        return bool(self._if_it_fits(self._start(config), self._surroundings(inputs, config), inputs, config)[0])

    # --- adding lines --------------------------------------------------------------------

    def advance(self, inputs: ChronicInputs, config: ChronicConfig, staging: Staging) -> str:
        """Take the lines that have settled since; returns "kept", "merged" or "rebuilt"."""
        base, lines = self.current(), inputs.transactions
        start, surroundings = self._start(config), self._surroundings(inputs, config)
        now, until = self._if_it_fits(start, surroundings, inputs, config)
        is_new = F.lit(True)
        if now:
            start, is_new = now["start"], ~_is_settled(now["until"])
            if until is None or until <= (now["until"] or ""):
                return "kept"
        else:
            _, until = self._look(lines, start, None, config)
        when = _is_dated_from(start) & _is_settled(until) & is_new
        relevant = universe.relevant_lines(inputs, config, staging, when=when)
        tagged = staging.write(universe.tagged_lines(relevant, config), "settled")
        lot = self._store(base + 1, parts_of(tagged, config))
        settled = _fingerprint(lines.where(when).select(*IDENTITY))
        self.name_version(
            base + 1,
            {
                "start": start,
                "whole_from": now.get("whole_from", start),
                "until": until,
                "surroundings": surroundings,
                "settled": _of_both(now["settled"], settled) if now else settled,
                "lots": [*now.get("lots", []), lot],
            },
        )
        return "merged" if now else "rebuilt"

    def _store(self, version: int, parts: Parts) -> str:
        lot = self.new_folder(version)
        for part, rows in parts.items():
            rows.sortWithinPartitions(*universe.PATIENT).write.parquet(f"{self.folder}/{lot}/{part}")
        return lot

    def compact(self, config: ChronicConfig) -> int:
        """Merge all lots into one, without what is older than the input months; returns the version."""
        base, now = self.current(), self.content()
        if len(now.get("lots", [])) < 2:
            return base
        parts = of_input_months(merged(*map(self._lot, now["lots"])), config, to_last=False)
        lot = self._store(base + 1, parts)
        self.name_version(base + 1, now | {"lots": [lot], "whole_from": self._start(config)})
        return base + 1

    # --- reading -------------------------------------------------------------------------

    def _lot(self, lot: str) -> Parts:
        return {part: self.spark.read.parquet(f"{self.folder}/{lot}/{part}") for part in KEYS}

    def lots(self, inputs: ChronicInputs, config: ChronicConfig, staging: Staging) -> list[Parts]:
        """The stored lots and that of the tail, of the input months."""
        now = self.content()
        stored = [self._lot(lot) for lot in now["lots"]]
        when = universe.in_input_months(config) & ~_is_settled(now["until"])
        relevant = universe.relevant_lines(inputs, config, staging, when=when)
        tail = staging.write(universe.tagged_lines(relevant, config), "tail")
        return [of_input_months(lot, config) for lot in [*stored, parts_of(tail, config)]]


class StateModel(ChronicModel):
    """The chronic model from its judged purchases on, over a state and the tail of the lines.

    The state is advanced before it is read.
    """

    def __init__(
        self,
        state: DayState,
        inputs: ChronicInputs,
        config: ChronicConfig,
        staging: Staging,
        only_patients_with: Column | None = None,
    ):
        """``only_patients_with`` as for the model over lines; few others are run with them."""
        super().__init__(inputs, config, staging, only_patients_with)
        self.state = state

    @cached_property
    def parts(self) -> Parts:
        self.state.advance(self.inputs, self.config, self.staging)
        lots = self.state.lots(self.inputs, self.config, self.staging)
        if self.only_patients_with is not None:
            # Stamps of the output are those of purchases, so other parts bring no news.
            purchases = reduce(DataFrame.unionByName, [lot["purchases"] for lot in lots])
            fresh = purchases.where(self.only_patients_with)
            wanted = may_be_among(fresh.select(*universe.PATIENT), universe.PATIENT, self.staging)
            lots = [{part: rows.where(wanted) for part, rows in lot.items()} for lot in lots]
        parts = merged(*lots)
        return parts | {"purchases": self.staging.write(parts["purchases"], "purchases")}

    @cached_property
    def hot_patients(self) -> HotKeys | None:
        return self._find_hot_patients(self.parts["purchases"])

    @cached_property
    def judged(self) -> DataFrame:
        judged = judged_from_parts(
            self.parts, self.inputs.patients, self.hot_patients, self.config, self.staging
        )
        return self.staging.write(judged, "judged")
