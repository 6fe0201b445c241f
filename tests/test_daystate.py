"""A state that lines are added to, beside the model over all lines."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from rxtrail.config import ChronicConfig, SkewLimits
from rxtrail.plans.chronic import ChronicModel
from rxtrail.plans.daystate import DayState, StateModel
from rxtrail.plans.refresh import refresh_store, refreshed_rows
from rxtrail.sources import derived
from rxtrail.sources.derived import SAMPLE_SETS
from rxtrail.sources.staging import Staging
from rxtrail.sources.versions import MonthlyVersions
from tests import samples
from tests.samples import moment

CONFIG = ChronicConfig(sets=SAMPLE_SETS, as_of=samples.AS_OF)
SF = "/root/testdata/sf0.001"
HOT = SkewLimits(hot_rows=3, broadcast_rows=0)


def rows(frame):
    return sorted(frame.collect(), key=str)


def loads(spark, tables, *stamps):
    """The inputs as they were when no line had a later stamp."""
    for stamp in stamps:
        lines = [r for r in tables["transactions"] if r["odu_updated_at_utc"] is None or r["odu_updated_at_utc"] <= stamp]
        yield samples.chronic_inputs(spark, tables | {"transactions": lines})


def with_missing_stamps(tables):
    lines = [r | {"odu_updated_at_utc": None} if n % 17 == 0 else r for n, r in enumerate(tables["transactions"])]
    return tables | {"transactions": lines}


@pytest.mark.parametrize("seed, skew", [(3, SkewLimits()), (4, HOT)], ids=["plain", "hot"])
def test_merging_equals_rebuilding(spark, tmp_path, seed, skew):
    tables = with_missing_stamps(samples.random_chronic_tables(seed, 700))
    config = replace(CONFIG, skew=skew)
    state = DayState(spark, str(tmp_path / "state"))
    done = []
    for inputs in loads(spark, tables, moment("1999-05-05"), moment("2000-11-20"), moment("2000-11-20"), moment("2003-01-01")):
        done.append(state.advance(inputs, config, Staging(spark)))
    assert done == ["rebuilt", "merged", "kept", "merged"]

    def compare(config, *stages):
        ours = StateModel(state, inputs, config, Staging(spark))
        whole = ChronicModel(inputs, config, Staging(spark))
        assert (ours.hot_patients is None) == (skew is not HOT)
        for stage in stages:
            assert rows(getattr(ours, stage)()) == rows(getattr(whole, stage)()) != [], stage

    compare(config, "corroboration_count", "chronic_purchases")
    assert state.compact(config) == 4 and len(state.content()["lots"]) == 1
    compare(replace(config, as_of=dt.date(2001, 9, 20)), "chronic_purchases")
    assert state.current() == 4


def changed_line(lines):
    """A settled line that gets another category and stamp in place."""
    nth = next(n for n, r in enumerate(lines) if r["leaf"] == 320 and r["is_revenue"])
    return [r | {"leaf": 390, "odu_updated_at_utc": moment("2002-01-01")} if n == nth else r for n, r in enumerate(lines)]


@pytest.mark.parametrize("change", ["changed", "removed", "late", "tags", "practices", "sets", "earlier"])
def test_a_state_that_no_longer_fits_is_built_anew(spark, tmp_path, change):
    tables = samples.random_chronic_tables(5, 400)
    state, config = DayState(spark, str(tmp_path / "state")), CONFIG
    assert state.advance(samples.chronic_inputs(spark, tables), config, Staging(spark)) == "rebuilt"
    lines = tables["transactions"]
    if change == "changed":
        tables["transactions"] = changed_line(lines)
    elif change == "removed":
        tables["transactions"] = lines[1:]
    elif change == "late":
        tables["transactions"] = [*lines, samples.tagged_line(390, 3, moment("2000-05-05"), 10**6)]
    elif change == "tags":
        tables["catalog_tags"] = tables["catalog_tags"][1:]
    elif change == "practices":
        tables["practice_info"] = tables["practice_info"][8:]
    elif change == "sets":
        config = replace(config, sets={**SAMPLE_SETS, "mab": frozenset({390, 2000})})
    else:
        config = replace(config, as_of=dt.date(2001, 6, 1))
    inputs = samples.chronic_inputs(spark, tables)
    assert not state.fits(inputs, config)
    if change in ("changed", "earlier"):
        ours = rows(StateModel(state, inputs, config, Staging(spark)).chronic_purchases())
        assert ours == rows(ChronicModel(inputs, config, Staging(spark)).chronic_purchases())
        assert state.current() == 2 and len(state.content()["lots"]) == 1


def test_a_refresh_over_a_state_writes_what_one_over_lines_does(spark, tmp_path):
    tables = samples.random_chronic_tables(6)
    state = DayState(spark, str(tmp_path / "state"))
    stores = [MonthlyVersions(spark, str(tmp_path / name)) for name in ("a", "b")]
    for inputs in loads(spark, tables, moment("2000-11-20"), moment("2003-01-01")):
        for store, used in zip(stores, (None, state), strict=True):
            refresh_store(inputs, CONFIG, Staging(spark), store, used)
        a, b = [rows(store.read()) for store in stores]
        assert a == b != []


def test_a_refresh_reads_few_lines(spark, tmp_path):
    """Settled lines of the state are not read again, nor parts of patients without news."""
    tables = samples.random_chronic_tables(7)
    state = DayState(spark, str(tmp_path / "state"))
    early, late = loads(spark, tables, moment("2001-07-01"), moment("2001-07-04"))
    target = StateModel(state, early, CONFIG, Staging(spark)).chronic_purchases()
    staging = Staging(spark)
    refreshed_rows(late, target, CONFIG, staging, state).collect()
    written = {p.split("-", 1)[1]: spark.read.parquet(f"{staging.folder}/{p}").count() for p in _names(staging.folder)}
    purchases = spark.read.parquet(f"{state.folder}/{state.content()['lots'][0]}/purchases").count()
    assert written["settled"] + written["tail"] < 0.1 * len(tables["transactions"])
    assert 0 < written["purchases"] < purchases


def counted(spark, lines):
    """The lines, and an accumulator of how many were read."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def look(stamp):
        seen.add(1)
        return True

    return lines.where(look("odu_updated_at_utc")), seen


def test_settled_lines_are_looked_at_once(spark, tmp_path):
    """Whether the state fits and how far lines have settled is one pass; the rest reads new lines."""
    tables = samples.random_chronic_tables(9, 400)
    state = DayState(spark, str(tmp_path / "state"))
    early, late = loads(spark, tables, moment("2001-07-01"), moment("2001-07-04"))
    assert state.advance(early, CONFIG, Staging(spark)) == "rebuilt"
    lines, seen = counted(spark, late.transactions)
    assert state.advance(replace(late, transactions=lines), CONFIG, Staging(spark)) == "merged"
    assert seen.value < 1.5 * late.transactions.count()
    assert state.fits(late, CONFIG)


def test_daystate_merge_makes_its_lines_once(spark, monkeypatch):
    made = derived.transactions
    lines, seen = counted(spark, made(spark, SF))
    monkeypatch.setattr(derived, "transactions", lambda *_: lines)
    assert not __spark_entry__.daystate_merge(spark, SF).isEmpty()
    assert seen.value <= 1.1 * made(spark, SF).count()


def _names(folder):
    import os

    return [n for n in os.listdir(folder.removeprefix("file:")) if not n.startswith(".")]


def test_empty_inputs(spark, tmp_path):
    tables = {name: [] for name in samples.random_chronic_tables(1, 1)}
    inputs = samples.chronic_inputs(spark, tables)
    state = DayState(spark, str(tmp_path / "state"))
    assert state.advance(inputs, CONFIG, Staging(spark)) == "rebuilt"
    assert StateModel(state, inputs, CONFIG, Staging(spark)).chronic_purchases().isEmpty()
    state.advance(inputs, CONFIG, Staging(spark))
    assert state.current() == 1


def test_old_lots_go(spark, tmp_path):
    tables = samples.random_chronic_tables(8, 300)
    state = DayState(spark, str(tmp_path / "state"))
    for inputs in loads(spark, tables, moment("2000-01-01"), moment("2003-01-01")):
        state.advance(inputs, CONFIG, Staging(spark))
    state.compact(CONFIG)
    state.remove_older(keep=1)
    assert state.versions() == [3] and state.folders(3) == set(_names(f"{state.folder}/data"))
    ours = rows(StateModel(state, inputs, CONFIG, Staging(spark)).chronic_purchases())
    assert ours == rows(ChronicModel(inputs, CONFIG, Staging(spark)).chronic_purchases())
