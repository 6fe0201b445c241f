"""Combining update stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def newest(left: Column, right: Column, null_wins: bool = False) -> Column:
    """The later stamp. A missing one is skipped, or makes the result missing."""
    later = F.greatest(left, right)
    return F.when(left.isNotNull() & right.isNotNull(), later) if null_wins else later
