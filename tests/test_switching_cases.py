"""Hand-made purchase histories."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rxtrail.config import SkewLimits, SwitchConfig
from rxtrail.operators import islands
from rxtrail.operators.timeline import Pieces
from rxtrail.plans.refresh import write_switching_report
from rxtrail.plans.switching import SwitchModel
from rxtrail.sources.staging import Staging
from tests.samples import moment, purchase, purchases_frame

ALPHA, ALPHA_INJ, GENERIC_ALPHA, BETA = 0, 1, 2, 4


def history(patient: int, *visits, **other) -> list[dict]:
    """Visits ten days apart, each one product or several."""
    rows = []
    for number, products in enumerate(visits):
        when = moment(dt.date(2000, 1, 1) + dt.timedelta(days=10 * number))
        for product in products if isinstance(products, tuple) else (products,):
            rows.append(purchase(patient, when, product, revenue=float(number), **other))
    return rows


def report(spark, rows: list[dict]) -> dict[int, list[tuple]]:
    model = SwitchModel(purchases_frame(spark, rows), SwitchConfig(), Staging(spark))
    found: dict[int, list[tuple]] = {}
    for row in model.nsaid_switching().collect():
        found.setdefault(row.patient_odu_id, []).append(
            (
                row.product_name,
                row.previous_drug,
                row.switch_yn,
                row.brand_name_switch_yn,
                row.previous_purchases,
            )
        )
    return found


def test_histories(spark):
    rows = (
        history(1, ALPHA)
        + history(2, ALPHA, ALPHA, BETA)
        + history(3, ALPHA, BETA, ALPHA)
        + history(4, (ALPHA, BETA), ALPHA)
        + history(5, ALPHA, ALPHA_INJ)
        + history(6, ALPHA, GENERIC_ALPHA)
        + history(7, GENERIC_ALPHA, ALPHA)
    )
    none = (None, False, False, None)
    assert report(spark, rows) == {
        1: [("Alphafen", *none)],
        2: [("Alphafen", *none), ("Alphafen", *none), ("Betacox", "alpha", True, False, 2)],
        3: [
            ("Alphafen", *none),
            ("Betacox", "alpha", True, False, 1),
            ("Alphafen", "beta", True, False, 1),
        ],
        # Bought together before, so no switch.
        4: [("Alphafen", *none), ("Betacox", *none), ("Alphafen", *none)],
        5: [("Alphafen", *none), ("Alphafen Inj", *none)],
        # Only leaving a brand is a brand switch.
        6: [("Alphafen", *none), ("Generic Alpha", "alpha", False, True, 1)],
        7: [("Generic Alpha", *none), ("Alphafen", "alpha", False, False, None)],
    }


def test_combination_is_no_switch(spark):
    """The product left is still bought, together with the new one."""
    found = report(spark, history(1, ALPHA, (ALPHA, BETA)))
    assert found[1][2] == ("Betacox", None, False, False, None)


def test_previous_visit_is_of_the_same_practice(spark):
    rows = history(1, ALPHA) + [purchase(1, moment("2000-03-01"), BETA, practice_odu_id=11)]
    assert report(spark, rows)[1][1] == ("Betacox", None, False, False, None)


def test_cohort(spark):
    rows = (
        history(1, ALPHA, 8, 9)
        + history(2, ALPHA, pain_type="Acute")
        + history(3, ALPHA, category_name="Opiate")
    )
    model = SwitchModel(purchases_frame(spark, rows), SwitchConfig(), Staging(spark))
    assert [row.product_name for row in model.chronic_nsaid_cohort().collect()] == ["Alphafen"]


def test_islands(spark):
    rows = history(1, ALPHA, ALPHA, BETA, BETA, BETA, ALPHA)
    model = SwitchModel(purchases_frame(spark, rows), SwitchConfig(), Staging(spark))
    found = model.product_islands().orderBy("transaction_datetime").collect()
    assert [row.island_id for row in found] == [1, 1, 2, 2, 2, 3]
    lengths = {r.island_id: r.previous_purchases for r in model.island_lengths().collect()}
    assert lengths == {1: 2, 2: 3, 3: 1}


@pytest.mark.parametrize("patient", [1, None])
def test_one_busy_day_in_pieces(spark, patient):
    """A history of one day is cut too, and the pieces go on from one another."""
    noon = moment("2000-01-01")
    rows = [
        purchase(patient, noon + dt.timedelta(seconds=i // 2 * (i > 9)), (ALPHA, ALPHA, BETA, GENERIC_ALPHA)[i % 4], practice_odu_id=10 + i % 2)
        for i in range(40)
    ]
    found = []
    for skew in (SkewLimits(), SkewLimits(hot_rows=9)):
        model = SwitchModel(purchases_frame(spark, rows), SwitchConfig(skew=skew), Staging(spark))
        assert (model.hot_patients is None) == (skew.hot_rows > 9)
        found.append(sorted(map(str, model.product_islands().collect())))
    assert found[0] == found[1] and found[0]


def tasks_rows(spark, monkeypatch, ask) -> list[int]:
    """Purchases in each task of the per-patient work of ``ask``, which gets a model of 400."""
    seen, step = [], islands.purchase_steps

    def looked_at(items):
        found = items.groupBy(F.spark_partition_id()).agg(F.sum("n_purchases").alias("n"))
        seen.extend(row.n for row in found.collect())
        return step(items)

    monkeypatch.setattr(islands, "purchase_steps", looked_at)
    rows = [row for patient in range(100) for row in history(patient, ALPHA, BETA, ALPHA, GENERIC_ALPHA)]
    config = SwitchConfig(skew=SkewLimits(hot_rows=20))
    ask(SwitchModel(purchases_frame(spark, rows), config, Staging(spark)))
    assert sum(seen) == 400
    return seen


def test_island_lengths_has_bounded_tasks(spark, monkeypatch):
    """However few shuffle partitions are set, a task of the per-patient work gets a bounded share."""
    assert max(tasks_rows(spark, monkeypatch, lambda model: model.island_lengths().collect())) <= 3 * 20


def test_nsaid_switching_has_bounded_tasks(spark, monkeypatch):
    assert max(tasks_rows(spark, monkeypatch, lambda model: model.nsaid_switching().collect())) <= 3 * 20


def test_stored_switch_report_has_bounded_tasks(spark, monkeypatch, tmp_path):
    path = str(tmp_path / "report")
    assert max(tasks_rows(spark, monkeypatch, lambda model: write_switching_report(model, path))) <= 3 * 20
    assert spark.read.parquet(path).count() == 400


def test_pieces_are_no_longer_than_asked(spark, tmp_path):
    rows = spark.range(4000).selectExpr("1 AS key", "timestamp'2000-01-01' AS time", "id AS place")
    cut = Pieces(Staging(spark, str(tmp_path)), 500).cut(rows, ["key"], ["time", "place"])
    pieces = cut.groupBy("_piece").agg(F.count("*").alias("n"), F.min("place").alias("a"), F.max("place").alias("z"))
    pieces = sorted(pieces.collect())
    assert len(pieces) == 8 and max(p.n for p in pieces) < 1000
    assert all(before.z < after.a for before, after in zip(pieces, pieces[1:], strict=False))
