import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from rxtrail.functions import dates, stamps, text


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def at(when: str):
    return F.lit(when).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "start, end, days, months, years",
    [
        ("2000-01-31 23:00:00", "2000-02-01 01:00:00", 1, 1, 0),
        ("2000-02-01 01:00:00", "2000-01-31 23:00:00", -1, -1, 0),
        ("1999-12-31 00:00:00", "2000-01-01 00:00:00", 1, 1, 1),
        ("2000-01-01 00:00:00", "2000-12-31 23:59:59", 365, 11, 0),
        ("2000-03-05 08:00:00", "2000-03-05 20:00:00", 0, 0, 0),
    ],
)
def test_differences_count_boundaries(spark, start, end, days, months, years):
    assert value(spark, dates.day_diff(at(start), at(end))) == days
    assert value(spark, dates.month_diff(at(start), at(end))) == months
    assert value(spark, dates.year_diff(at(start), at(end))) == years
    number = dates.day_number(at(end)) - dates.day_number(at(start))
    assert value(spark, number) == days


@pytest.mark.parametrize("day", ["1999-12-31", "2000-01-01", "2000-02-29"])
def test_month_index_round_trip(spark, day):
    date = dt.date.fromisoformat(day)
    index = dates.month_index(F.lit(date))
    assert value(spark, dates.first_of_month(index)) == date.replace(day=1)


def test_months_before(spark):
    today = F.lit(dt.date(2001, 8, 17))
    assert value(spark, dates.months_before(today, 49)) == dt.datetime(1997, 7, 1)
    assert value(spark, dates.months_before(today, 0)) == dt.datetime(2001, 8, 1)


def test_newest(spark):
    some, none = at("2000-01-01 00:00:00"), F.lit(None).cast("timestamp_ntz")
    assert value(spark, stamps.newest(some, none)) == dt.datetime(2000, 1, 1)
    assert value(spark, stamps.newest(some, none, null_wins=True)) is None


def test_product_names(spark):
    assert value(spark, text.base_product(F.lit("Betacox Inj"), " Inj")) == "Betacox"
    empty = F.array().cast("array<string>")
    assert value(spark, text.listing(empty)) == ""
    assert value(spark, text.listing(F.array(F.lit("b"), F.lit("a")))) == "a, b"
    assert value(spark, text.mentions(F.lit("Alphafen Inj, X"), F.lit("alphaFEN")))
    assert value(spark, text.mentions(F.lit("Alphafen"), F.lit("A_pha%")))
    assert not value(spark, text.mentions(F.lit(""), F.lit("Alphafen")))
    assert not value(spark, text.mentions(F.lit("50%"), F.lit("0\\%")))
    assert value(spark, text.mentions(F.lit("x beta\\cox"), F.lit("Beta\\cox")))
    assert value(spark, text.mentions(F.lit("x beta\\cox"), F.lit("Bet_\\cox")))


def test_wildcards_are_met_without_a_pattern_per_row(spark):
    """Random texts and names over few characters, held against a pattern of each name."""
    draw = random.Random(5)
    some = lambda letters, n: "".join(draw.choice(letters) for _ in range(draw.randrange(n)))
    pairs = [(some("abB\\,\n\U0001f600", 9), some("aAb\\%_%_\U0001f600", 6)) for _ in range(3000)]
    pairs += [(None, "a%"), ("a", None), (None, "%"), ("", "%"), ("", "_"), ("ab", "b%a"), ("aab", "a_%b")]
    rows = spark.createDataFrame(pairs, "text string, name string")
    found = rows.select("text", "name", text.mentions(F.col("text"), F.col("name")).alias("found"))
    for r in found.collect():
        if r.text is None or r.name is None:
            assert r.found is None
            continue
        wild = {"%": ".*", "_": "."}
        pattern = "".join(wild.get(c) or re.escape(c) for c in r.name.lower())
        assert r.found == bool(re.search(pattern, r.text.lower(), re.DOTALL)), (r.text, r.name)
    plan = found._jdf.queryExecution().toString().lower()
    assert "like" not in plan and "regexp" not in plan
