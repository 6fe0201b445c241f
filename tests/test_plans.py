"""What the physical plans must and must not hold."""

import datetime as dt
import re

import pytest

from rxtrail.config import ChronicConfig, SkewLimits, SwitchConfig
from rxtrail.operators import repeats, universe
from rxtrail.operators.bloom import may_be_among
from rxtrail.operators.skew import dimension_join, find_hot_keys
from rxtrail.plans.chronic import ChronicModel
from rxtrail.plans.switching import SwitchModel
from rxtrail.sources import derived
from rxtrail.sources.relations import ChronicInputs
from rxtrail.sources.derived import SAMPLE_SETS
from rxtrail.sources.staging import Staging

SF = "/root/testdata/sf0.001"
CONFIG = ChronicConfig(sets=SAMPLE_SETS, as_of=dt.date(2001, 8, 1))


class Plans(Staging):
    """Keeps the plan of every stage."""

    def __init__(self, spark):
        super().__init__(spark)
        self.plans: dict[str, str] = {}

    def write(self, frame, name):
        self.plans[name] = plan(frame)
        return super().write(frame, name)


def plan(frame) -> str:
    text = frame._jdf.queryExecution().executedPlan().toString()
    return re.sub(r"#\d+L?", "", text)


@pytest.fixture()
def no_automatic_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture()
def stored(spark, tmp_path):
    """Inputs as stored tables, so that plans start at their scans."""
    inputs = derived.chronic_inputs(spark, SF)

    def keep(frame, name):
        path = str(tmp_path / name)
        frame.write.parquet(path)
        return spark.read.parquet(path)

    return ChronicInputs(
        keep(inputs.transactions, "t"),
        keep(inputs.patients, "p"),
        keep(inputs.practice_info, "w"),
        keep(inputs.catalog_tags, "c"),
    )


def check(plans: dict[str, str]) -> None:
    for name, text in plans.items():
        for unwanted in ("SinglePartition", "NestedLoop", "CartesianProduct", "PythonUDF"):
            assert unwanted not in text, (name, unwanted)


def test_chronic(spark, no_automatic_broadcast, stored):
    staging = Plans(spark)
    model = ChronicModel(stored, CONFIG, staging)
    staging.plans["chronic_purchases"] = plan(model.chronic_purchases())
    check(staging.plans)
    # Rows do not move before they are staged: the only shuffle is the whitelist's own.
    tagged = staging.plans["tagged"]
    assert tagged.count("Exchange hashpartitioning") == 1
    assert "Exchange hashpartitioning(server_odu_id, practice_odu_id" in tagged
    # Judging moves the lines once and the patients once, both by patient.
    by_patient = "Exchange hashpartitioning(server_odu_id, patient_odu_id, 4)"
    judged = staging.plans["judged"]
    assert judged.count("Exchange") == judged.count(by_patient) == 2
    # Counting repeats and dropping copies moves the survivors once.
    final = staging.plans["chronic_purchases"]
    assert final.count("Exchange") == final.count(by_patient) == 1


def test_large_dimensions(spark, no_automatic_broadcast, stored):
    """Joined by shuffle: narrow lines, no copies dropped by whole rows, relevant ones last."""
    staging = Plans(spark)
    config = ChronicConfig(
        sets=SAMPLE_SETS, as_of=CONFIG.as_of, skew=SkewLimits(hot_rows=10_000_000, broadcast_rows=0)
    )
    model = ChronicModel(stored, config, staging)
    staging.plans["tag_assignment"] = plan(model.tag_assignment())
    assert not model.tagged.isEmpty()
    tagged = staging.plans["tagged"]
    for text in (tagged, staging.plans["tag_assignment"]):
        assert "BroadcastHashJoin" not in text and "SinglePartition" not in text
        # Lines with an item and their tags move by item, once each.
        assert text.count("Exchange hashpartitioning(catalog_source_server_odu_id, catalog_odu_id") == 2
    by_practice = "Exchange hashpartitioning(server_odu_id, practice_odu_id"
    for moved in (m.start() for m in re.finditer(re.escape(by_practice), tagged)):
        above = tagged[moved:]
        assert above.index("Filter") < above.index("FileScan")
    # No copies of lines are dropped, and their descriptions never move.
    assert "HashAggregate(keys=[server_odu_id, patient_odu_id" not in tagged
    for line in tagged.split("\n"):
        assert "description" not in line or re.search(r"- (\* )?(Filter|FileScan)", line), line


def test_filters_and_columns_reach_the_scan(spark, stored):
    lines = universe.recent_revenue_lines(stored.transactions, CONFIG)
    text = plan(lines.select("patient_odu_id"))
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    assert "GreaterThanOrEqual(transaction_datetime,1997-07-01T00:00)" in pushed
    assert "LessThan(transaction_datetime,2001-08-01T00:00)" in pushed
    assert "is_revenue" in pushed
    columns = re.search(r"ReadSchema: struct<([^>]*)", text).group(1)
    assert "catalog" not in columns and "revenue_category" not in columns


def test_switching(spark, no_automatic_broadcast, tmp_path):
    path = str(tmp_path / "purchases")
    derived.pain_purchases(spark, SF).write.parquet(path)
    staging = Plans(spark)
    model = SwitchModel(spark.read.parquet(path), SwitchConfig(), staging)
    staging.plans["nsaid_switching"] = plan(model.nsaid_switching())
    check(staging.plans)
    scan = staging.plans["purchases"]
    assert "EqualTo(pain_type,Chronic)" in scan and "EqualTo(category_name,NSAIDs)" in scan
    # Items, visits and islands all share one shuffle by patient; the rest of the report is
    # the join of purchases with their items, and the sort.
    report = staging.plans["nsaid_switching"]
    assert report.count("Exchange hashpartitioning(patient_odu_id, 4)") == 1
    assert report.count("Exchange rangepartitioning") == 1
    assert report.count("Exchange") == 4


def test_nothing_depends_on_partitions(spark):
    """More partitions and shuffled rows give the same rows."""
    def run():
        model = SwitchModel(derived.pain_purchases(spark, SF), SwitchConfig(), Staging(spark))
        return sorted(map(str, model.nsaid_switching().collect()))

    before = run()
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert run() == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_two_newest_stamps_need_no_window(spark):
    """One date holds nearly all rows; ids tie in stamps, and some have none."""
    of_ids = spark.range(3000).selectExpr(
        "1L AS server_odu_id", "id % 2 AS patient_odu_id", "'NSAIDs' AS rule",
        "make_date(2000, 1, 1 + if(id < 2990, 0, cast(id % 5 AS int))) AS event_date", "id AS transaction_odu_id",
        "if(id % 7 = 0, NULL, timestamp_ntz'2000-01-01' + make_dt_interval(cast(id % 50 AS int))) AS stamp",
    )
    rows, wanted = of_ids.collect(), {}
    for r in rows:
        wanted.setdefault((r.patient_odu_id, r.event_date), []).append((r.stamp is not None, r.stamp, r.transaction_odu_id))
    limits = SkewLimits(hot_rows=100)
    for hot in (None, find_hot_keys(of_ids, universe.PATIENT, limits, Staging(spark))):
        found = repeats.two_newest(of_ids, hot)
        assert "Window" not in plan(found)
        two = {}
        for r in found.collect():
            two.setdefault((r.patient_odu_id, r.event_date), []).append((r.stamp is not None, r.stamp, r.transaction_odu_id))
        assert {k: sorted(v, reverse=True) for k, v in two.items()} == {k: sorted(v, reverse=True)[:2] for k, v in wanted.items()}


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_only_rows_that_may_match_a_large_dimension_move(spark, tmp_path, how, no_automatic_broadcast):
    spark.range(20_000).selectExpr("if(id % 11 = 0, NULL, id % 5000) AS k", "id AS v").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    dimension = spark.range(40).selectExpr("id * 100 AS k", "id AS d")
    dimension = dimension if how == "left" else dimension.select("k")
    small = dimension_join(rows, dimension, ["k"], SkewLimits(), Staging(spark), how)
    limits = SkewLimits(broadcast_rows=0)
    large = dimension_join(rows, dimension, ["k"], limits, Staging(spark), how)
    assert sorted(map(str, small.collect())) == sorted(map(str, large.select(*small.columns).collect()))
    text = plan(large)
    below = text.split("Exchange hashpartitioning")[1:]
    assert "getbit" in text and any("getbit" in part.split("Exchange")[0] for part in below)
    moved = rows.where("k IS NOT NULL").where(may_be_among(dimension.select("k"), ["k"], Staging(spark)))
    assert moved.where("k % 100 <> 0 OR k >= 4000").count() < 20 and moved.count() < 300
