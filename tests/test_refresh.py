import datetime as dt
from dataclasses import replace
from pathlib import Path
from types import SimpleNamespace

import pytest

from rxtrail.config import ChronicConfig, SkewLimits
from rxtrail.operators.bloom import may_be_among
from rxtrail.plans.chronic import ChronicModel
from rxtrail.plans import refresh
from rxtrail.plans.refresh import merged, rebuild_changes, refresh_store, refresh_table, refreshed_rows, rows_with_news
from rxtrail.sources import derived
from rxtrail.sources.relations import RELATIONS, conform, read_chronic_inputs, read_relation
from rxtrail.sources.derived import SAMPLE_SETS
from rxtrail.sources.staging import Staging, shared_folder
from rxtrail.sources.versions import MonthlyVersions
from tests import samples
from tests.samples import moment

SF = "/root/testdata/sf0.001"
CONFIG = ChronicConfig(sets=SAMPLE_SETS, as_of=dt.date(2001, 8, 1))
SCHEMA = RELATIONS["chronic_purchases"]
NEWEST = dt.datetime(2001, 6, 2, 12)


def output(spark, *rows: tuple[int, dt.datetime | None]):
    """Rows of (purchase id, stamp)."""
    given = [(1, 1, 10, "canine", id, at, id, moment("2001-01-01"), "DMOAD", 0) for id, at in rows]
    return spark.createDataFrame(given, SCHEMA)


def stamps(frame) -> dict:
    return {row.transaction_odu_id: row.odu_updated_at_utc for row in frame.collect()}


def test_overlap_of_a_day(spark):
    hour = dt.timedelta(hours=1)
    target = output(spark, (1, NEWEST), (2, NEWEST - 99 * hour))
    result = output(
        spark, (1, NEWEST), (2, NEWEST - 23 * hour), (3, NEWEST - 25 * hour), (4, None)
    )
    emitted = rows_with_news(result, target, CONFIG)
    assert stamps(emitted) == {1: NEWEST, 2: NEWEST - 23 * hour}
    assert stamps(merged(target, emitted)) == stamps(emitted)


def test_rows_that_left_the_result_stay(spark):
    target = output(spark, (1, NEWEST), (2, NEWEST))
    emitted = rows_with_news(output(spark, (1, NEWEST)), target, CONFIG)
    assert stamps(merged(target, emitted)) == {1: NEWEST, 2: NEWEST}


@pytest.mark.parametrize("empty", [True, False])
def test_first_run(spark, empty):
    result = output(spark, (1, NEWEST), (2, None))
    target = output(spark) if empty else None
    assert stamps(rows_with_news(result, target, CONFIG)) == stamps(result)


def test_stored_refresh(spark, tmp_path):
    """Refreshing without a change changes nothing."""
    inputs = derived.chronic_inputs(spark, SF)
    first, second = str(tmp_path / "first"), str(tmp_path / "second")
    refresh_table(inputs, CONFIG, Staging(spark), first)
    refresh_table(inputs, CONFIG, Staging(spark), second, first)
    rows = [read_relation(spark, "chronic_purchases", p).collect() for p in (first, second)]
    assert sorted(rows[0]) == sorted(rows[1]) and len(rows[0]) == 254
    assert list((tmp_path / "first").glob("event_month=2000-01/*.parquet"))


@pytest.mark.parametrize("skew", [SkewLimits(), SkewLimits(hot_rows=20)], ids=["plain", "hot"])
def test_only_patients_with_news_are_run(spark, skew):
    """Their fresh rows are the fresh rows of a whole run."""
    inputs = derived.chronic_inputs(spark, SF)
    config = replace(CONFIG, skew=skew)
    whole = ChronicModel(inputs, config, Staging(spark))
    target = whole.staging.write(
        whole.chronic_purchases().where("odu_updated_at_utc < '2001-06-15'"), "target"
    )
    wanted = rows_with_news(whole.chronic_purchases(), target, config).collect()
    found = refreshed_rows(inputs, target, config, Staging(spark)).collect()
    assert sorted(found) == sorted(wanted) and wanted


def test_inputs_from_folders_and_tables(spark, tmp_path):
    inputs = derived.chronic_inputs(spark, SF)
    inputs.transactions.write.parquet(f"{tmp_path}/transactions")
    inputs.patients.write.parquet(f"{tmp_path}/patients")
    inputs.practice_info.write.parquet(f"{tmp_path}/syndicated_practice_info")
    inputs.catalog_tags.write.parquet(f"{tmp_path}/catalog_tag_mappings")
    stored = read_chronic_inputs(spark, str(tmp_path))
    assert ChronicModel(stored, CONFIG, Staging(spark)).chronic_purchases().count() == 254
    stored.patients.createOrReplaceTempView("patients")
    assert read_relation(spark, "patients").count() == inputs.patients.count()


def test_contract(spark):
    frame = spark.sql("SELECT 1 AS server_odu_id, 'x' AS patient_odu_id, 'canine' AS species")
    with pytest.raises(ValueError, match="patient_odu_id is string.*birth_date is missing"):
        conform(frame, "patients")


def test_stages_go_to_the_folder_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert Staging(spark).folder.startswith(folder)


def test_a_cluster_must_name_a_shared_folder():
    conf = SimpleNamespace(get=lambda key, default: default)
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(conf=conf, sparkContext=context))


@pytest.mark.parametrize("skew", [SkewLimits(), SkewLimits(hot_rows=2)], ids=["plain", "hot"])
def test_an_id_on_two_dates_survives_a_refresh(spark, tmp_path, skew):
    days = {7: ["2000-01-01", "2000-03-01"], 8: ["2000-02-01"]}
    lines = [samples.tagged_line(390, 0, moment(d), id) for id, dates in days.items() for d in dates]
    tables = samples.random_chronic_tables(1, 1) | {"transactions": lines}
    inputs, config = samples.chronic_inputs(spark, tables), replace(CONFIG, skew=skew)
    paths = [None, str(tmp_path / "a"), str(tmp_path / "b")]
    for old, new in zip(paths, paths[1:], strict=False):
        staging = Staging(spark)
        refresh_table(inputs, config, staging, new, old)
        assert not Path(staging.folder.removeprefix("file:")).exists()
    rows = [sorted(read_relation(spark, "chronic_purchases", p).collect()) for p in paths[1:]]
    assert rows[0] == rows[1] and len(rows[0]) == 3


def test_bloom_filter_keeps_all_wanted_keys(spark):
    keys = ("server_odu_id", "patient_odu_id")
    every = spark.range(40_000).selectExpr("id % 3 AS server_odu_id", "if(id = 5, NULL, id) AS patient_odu_id")
    wanted = every.where("patient_odu_id IS NULL OR patient_odu_id % 20 = 7")
    for bits, most in ((1 << 23, 0), (1 << 15, 300), (64, 40_000)):
        found = every.where(may_be_among(wanted, keys, Staging(spark), bits=bits)).select(*keys).collect()
        assert set(wanted.collect()) <= set(found) and len(found) <= wanted.count() + most
    assert every.where(may_be_among(wanted.where("false"), keys, Staging(spark))).isEmpty()


def histories(patients: range, last_update: dt.datetime, days=("2000-01-05", "2000-03-05", "2000-06-05")) -> list[dict]:
    """Purchases that repeat; those of patient 3 were updated later on."""
    return [
        samples.tagged_line(274, p, moment(d), 100 * p + i, odu_updated_at_utc=last_update if p == 3 else moment(d))
        for p in patients
        for i, d in enumerate(days)
    ]


def test_only_lines_of_patients_with_news_are_staged(spark, tmp_path):
    patients = range(1, 201)
    target = ChronicModel(
        samples.chronic_inputs(spark, samples.whole_tables(histories(patients, moment("2000-01-05")))), CONFIG, Staging(spark)
    ).chronic_purchases()
    tables = samples.whole_tables(histories(patients, moment("2001-01-01")))
    inputs = samples.chronic_inputs(spark, tables)
    target = Staging(spark).write(target, "target")
    model = ChronicModel(inputs, CONFIG, Staging(spark), refresh.is_fresh(target, CONFIG))
    # The newest stamps of all are those of the last day, which every patient but the third has.
    assert model.tagged.count() == 600
    older = target.where("odu_updated_at_utc IS NULL").unionByName(output(spark, (1, moment("2000-12-01"))))
    model = ChronicModel(inputs, CONFIG, Staging(spark), refresh.is_fresh(older, CONFIG))
    assert {r.patient_odu_id for r in model.tagged.collect()} == {3} and model.tagged.count() == 3
    plan = model._may_be_wanted()._jc.toString()
    assert "getbit" in plan


def test_a_fresh_tag_makes_its_items_patients_fresh(spark):
    lines = [samples.tagged_line(56, p, moment("2000-01-05"), p) for p in (1, 2)] + histories(range(3, 9), moment("2000-01-05"))
    tables = samples.whole_tables(lines)
    tables["catalog_tags"] = [t | {"odu_updated_at_utc": moment("2001-05-01")} for t in tables["catalog_tags"]]
    inputs = samples.chronic_inputs(spark, tables)
    whole = ChronicModel(inputs, CONFIG, Staging(spark)).chronic_purchases()
    target = output(spark, (1, moment("2001-01-01")))
    found = refreshed_rows(inputs, target, CONFIG, Staging(spark)).collect()
    assert sorted(found) == sorted(rows_with_news(whole, target, CONFIG).collect())
    assert {r.patient_odu_id for r in found} == {1, 2}


@pytest.fixture()
def store(spark, tmp_path):
    return MonthlyVersions(spark, str(tmp_path / "store"))


def stored_files(store) -> dict[str, list[str]]:
    return {m: sorted(x.name for x in Path(f"{store.folder}/{f}").iterdir()) for m, f in store.months().items()}


def test_a_refresh_writes_the_months_it_touches(spark, store):
    lines = histories(range(1, 9), moment("2000-01-05"))
    inputs = samples.chronic_inputs(spark, samples.whole_tables(lines))
    assert refresh_store(inputs, CONFIG, Staging(spark), store) == 1
    first, rows = stored_files(store), sorted(store.read().collect())
    assert first.keys() == {"2000-01", "2000-03", "2000-06"} and len(rows) == 24
    # A single purchase of a patient of its own, in a month that is there and one that is not.
    for version, (month, id) in enumerate([("2000-03", 5000), ("2001-03", 5001)], 2):
        lines = [*lines, samples.tagged_line(390, 50, moment(f"{month}-20"), id, odu_updated_at_utc=moment("2001-06-01"))]
        inputs = samples.chronic_inputs(spark, samples.whole_tables(lines))
        staging = Staging(spark)
        assert refresh_store(inputs, CONFIG, staging, store) == version
        assert not Path(staging.folder.removeprefix("file:")).exists()
    now = stored_files(store)
    assert now.keys() == first.keys() | {"2001-03"}
    assert {m for m in first if now[m] != first[m]} == {"2000-03"}
    whole = ChronicModel(inputs, CONFIG, Staging(spark)).chronic_purchases()
    assert sorted(store.read().collect()) == sorted(whole.collect())
    assert sorted(store.read(1).collect()) == rows
    store.remove_older(keep=1)
    assert store.versions() == [3] and sorted(store.read().collect()) == sorted(whole.collect())
    assert {f.split("/")[1] for f in store.months().values()} == {x.name for x in Path(f"{store.folder}/data").iterdir()}


def test_rows_that_change_month_leave_the_old_one(spark, store):
    make = lambda day, at: samples.chronic_inputs(
        spark, samples.whole_tables([samples.tagged_line(390, 1, moment(day), 7, odu_updated_at_utc=moment(at))])
    )
    refresh_store(make("2000-02-01", "2000-02-01"), CONFIG, Staging(spark), store)
    refresh_store(make("2000-04-01", "2000-05-01"), CONFIG, Staging(spark), store)
    assert store.months().keys() == {"2000-04"} and store.read().count() == 1


def test_a_run_that_dies_leaves_the_old_version(spark, store, monkeypatch):
    inputs = samples.chronic_inputs(spark, samples.whole_tables(histories(range(1, 4), moment("2000-01-05"))))
    refresh_store(inputs, CONFIG, Staging(spark), store)
    rows = sorted(store.read().collect())

    def dies(*_):
        raise RuntimeError("lost")

    assert refresh_store(inputs, CONFIG, Staging(spark), store) == 1  # nothing to write
    more = [samples.tagged_line(390, 50, moment("2000-03-20"), 5000, odu_updated_at_utc=moment("2001-06-01"))]
    later = samples.chronic_inputs(spark, samples.whole_tables(histories(range(1, 4), moment("2000-01-05")) + more))
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(store, "_name_months", dies)
        refresh_store(later, CONFIG, Staging(spark), store)
    assert store.current() == 1 and sorted(store.read().collect()) == rows
    assert refresh_store(later, CONFIG, Staging(spark), store) == 2
    assert store.read().count() == len(rows) + 1
    store.remove_older(keep=1)
    assert len(list(Path(f"{store.folder}/data").iterdir())) <= 2


def test_of_two_runs_from_one_version_one_fails(spark, store):
    write = lambda path: refresh.write_output(output(spark, (1, NEWEST)), path)
    assert store.publish(write, None, 0) == 1
    assert store.publish(write, [], 1) == 1
    with pytest.raises(RuntimeError, match="another run"):
        store.publish(write, None, 0)
    assert store.versions() == [1] and store.read().count() == 1


def test_empty_store(spark, store):
    assert store.current() == 0 and store.read().isEmpty() and not store.months()


def test_changes_make_a_rebuild(spark):
    inputs = derived.chronic_inputs(spark, SF)
    earlier = ChronicModel(inputs, replace(CONFIG, as_of=dt.date(2001, 3, 1)), Staging(spark))
    target = earlier.staging.write(earlier.chronic_purchases(), "target")
    changed = rebuild_changes(inputs, target, CONFIG, Staging(spark)).collect()
    kinds = {k: [tuple(r)[:-1] for r in changed if r.change == k] for k in ("inserted", "replacing", "removed", "replaced")}
    assert all(kinds.values())
    now = [tuple(r) for r in target.collect()]
    for row in kinds["removed"] + kinds["replaced"]:
        now.remove(row)
    now += kinds["inserted"] + kinds["replacing"]
    whole = ChronicModel(inputs, CONFIG, Staging(spark)).chronic_purchases()
    assert sorted(now) == sorted(tuple(r) for r in whole.collect())


def test_changes_count_copies(spark):
    one, two = output(spark, (1, NEWEST), (1, NEWEST), (2, None)), output(spark, (1, NEWEST), (2, NEWEST), (3, None))
    found = sorted((r.transaction_odu_id, r.change) for r in refresh.changes(one, two).collect())
    assert found == [(1, "removed"), (2, "replaced"), (2, "replacing"), (3, "inserted")]
    assert refresh.changes(two, two).isEmpty()
