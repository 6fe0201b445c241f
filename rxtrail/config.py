"""Everything a run can vary: category sets, windows, thresholds, skew limits."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Category and catalog-tag ids the rules name directly.
FIXED_IDS: dict[str, frozenset[int]] = {
    "joint_diet": frozenset({56}),
    "urinalysis": frozenset({60}),
    "exam": frozenset({7}),
    "vaccine": frozenset({16}),
    "analgesic": frozenset({78}),
    "anticonvulsant": frozenset({207, 208}),
    "antidepressant": frozenset({209}),
    "dmoad": frozenset({251}),
    "sedative": frozenset({260, 261}),
    "nsaid_category": frozenset({274}),
    "supplement": frozenset({285}),
}

@dataclass(frozen=True)
class SkewLimits:
    """When a key counts as hot, and what may be broadcast.

    A key is hot from ``hot_rows`` rows on and dealt over one slot per ``hot_rows`` rows.
    Up to ``max_hot_keys`` hot keys are broadcast; more are an error.
    """

    hot_rows: int = 250_000
    max_hot_keys: int = 1_000_000
    broadcast_rows: int = 500_000


@dataclass(frozen=True)
class ChronicConfig:
    # Members of the installation's category sets, by name; there is no default.
    sets: Mapping[str, frozenset[int]]
    as_of: dt.date | None = None
    input_months: int = 49
    output_months: int = 36
    repeat_months: int = 12
    lookback_months: int = 12
    min_repeats: int = 2
    min_repeats_alternative: int = 3
    min_age: int = 3
    min_validators: int = 2
    overlap_hours: int = 24
    # Count repeats of anti-inflammatories too; off, none of them is ever chronic.
    count_anti_inflammatory: bool = False
    # A missing stamp makes the combined stamp missing, instead of being skipped.
    null_stamps_win: bool = False
    skew: SkewLimits = SkewLimits()

    def ids(self, *names: str) -> list[int]:
        """Members of the named sets together, sorted."""
        found: set[int] = set()
        for name in names:
            found |= self.sets[name] if name in self.sets else FIXED_IDS[name]
        return sorted(found)

    def member(self, column: str, *names: str) -> Column:
        """True where ``column`` holds an id of any named set, else false (never NULL)."""
        ids = ", ".join(map(str, self.ids(*names)))
        return F.expr(f"coalesce({column} IN ({ids}), false)") if ids else F.lit(False)

    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)


@dataclass(frozen=True)
class SwitchConfig:
    pain_type: str = "Chronic"
    category_name: str = "NSAIDs"
    # Unnamed products that are left out.
    unnamed_products: tuple[str, ...] = ("Other NSAID", "Other NSAID Inj")
    # Fixed value: an injectable counts as the same product as its base form.
    injectable_suffix: str = " Inj"
    skew: SkewLimits = SkewLimits()
