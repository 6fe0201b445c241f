"""Calendar arithmetic that counts boundaries crossed, not elapsed time.

Spark's three-argument ``datediff`` counts whole elapsed units (Jan 31 to Feb 1 is 0
months); the models need calendar differences (that pair is 1 month apart).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_number(when: Column) -> Column:
    """Days since 1970-01-01, an int that RANGE frames can step over."""
    return F.unix_date(F.to_date(when))


def month_index(when: Column) -> Column:
    """Months since year 0, an int that RANGE frames can step over."""
    return F.year(when) * 12 + F.month(when) - 1


def first_of_month(index: Column) -> Column:
    """The date on which the month with this index starts."""
    return F.make_date(F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"), F.lit(1))


def day_diff(start: Column, end: Column) -> Column:
    return F.datediff(F.to_date(end), F.to_date(start))


def month_diff(start: Column, end: Column) -> Column:
    return month_index(end) - month_index(start)


def year_diff(start: Column, end: Column) -> Column:
    return F.year(end) - F.year(start)


def months_before(today: Column, months: int) -> Column:
    """Start of the month ``months`` months before the month of ``today``."""
    return F.add_months(F.trunc(today, "MM"), -months).cast("timestamp_ntz")
