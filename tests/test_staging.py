"""Runs that are taken up again, and folders that nobody takes up."""

import datetime as dt
import os
import time
from dataclasses import replace
from pathlib import Path

import pytest

from rxtrail.config import ChronicConfig
from rxtrail.plans.chronic import ChronicModel
from rxtrail.plans.refresh import refresh_store
from rxtrail.sources import derived
from rxtrail.sources.derived import SAMPLE_SETS
from rxtrail.sources.relations import read_chronic_inputs
from rxtrail.sources.staging import Staging, remove_abandoned, run_key
from rxtrail.sources.versions import MonthlyVersions

SF = "/root/testdata/sf0.001"
CONFIG = ChronicConfig(sets=SAMPLE_SETS, as_of=dt.date(2001, 8, 1))


@pytest.fixture()
def inputs(spark, tmp_path):
    made = derived.chronic_inputs(spark, SF)
    for frame, name in (
        (made.transactions, "transactions"), (made.patients, "patients"),
        (made.practice_info, "syndicated_practice_info"), (made.catalog_tags, "catalog_tag_mappings"),
    ):
        frame.write.parquet(f"{tmp_path}/in/{name}")
    return read_chronic_inputs(spark, f"{tmp_path}/in")


def key_of(inputs, config=CONFIG):
    return run_key(inputs.transactions, inputs.patients, inputs.practice_info, inputs.catalog_tags, settings=config)


def local(path: str) -> Path:
    return Path(path.removeprefix("file:"))


class Counted(Staging):
    """Counts the stages that are made, and loses its driver after some of them."""

    def __init__(self, *args, lost_after: int = 99, **named):
        super().__init__(*args, **named)
        self.made, self.lost_after = [], lost_after

    def store(self, frame, name):
        if len(self.made) == self.lost_after:
            # What a stage leaves that was being written.
            path = local(f"{self.folder}/{self._written + 1:02d}-{name}")
            path.mkdir(parents=True)
            (path / "part-00000.parquet").write_text("half a file")
            raise KeyboardInterrupt
        there = {p.parent.name for p in local(self.folder).glob("*/_SUCCESS")}
        path = super().store(frame, name)
        if Path(path).name not in there:
            self.made.append(name)
        return path


def test_a_run_is_taken_up_where_it_was_lost(spark, inputs, tmp_path):
    key, store = key_of(inputs), MonthlyVersions(spark, f"{tmp_path}/out")
    lost = Counted(spark, key=key, lost_after=2)
    with pytest.raises(KeyboardInterrupt):
        refresh_store(inputs, CONFIG, lost, store)
    assert len(lost.made) == 2 and store.current() == 0 and local(lost.folder).exists()
    again = Counted(spark, key=key)
    refresh_store(inputs, CONFIG, again, store)
    plain = Counted(spark)
    whole = ChronicModel(inputs, CONFIG, plain).chronic_purchases().collect()
    assert lost.made + again.made == plain.made
    assert sorted(store.read().collect()) == sorted(whole)
    assert not local(again.folder).exists()


def test_keys_follow_inputs_and_settings(spark, inputs, tmp_path):
    key = key_of(inputs)
    again = read_chronic_inputs(spark, f"{tmp_path}/in")
    assert key_of(again) == key
    assert key_of(inputs, replace(CONFIG, as_of=dt.date(2001, 7, 1))) != key
    assert key_of(replace(inputs, patients=inputs.patients.where("species = 'canine'"))) != key
    inputs.patients.limit(1).write.mode("append").parquet(f"{tmp_path}/in/patients")
    assert key_of(read_chronic_inputs(spark, f"{tmp_path}/in")) != key


def test_abandoned_folders_go(spark, tmp_path):
    old, new = Staging(spark, str(tmp_path)), Staging(spark, str(tmp_path), key="k")
    for staging in (old, new):
        staging.write(spark.range(3), "numbers")
    (tmp_path / "something else").mkdir()
    past = time.time() - 5 * 3600
    for path in [local(old.folder), *local(old.folder).iterdir(), tmp_path / "something else"]:
        os.utime(path, (past, past))
    assert remove_abandoned(spark, 4, str(tmp_path)) == [Path(old.folder).name]
    assert {p.name for p in tmp_path.iterdir()} == {"rxtrail-k", "something else"}
    assert remove_abandoned(spark, 4, f"{tmp_path}/none") == []
