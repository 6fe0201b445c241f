"""Every cell of the invalidation rules, the tags, the gate and the repeat thresholds."""

import datetime as dt
import itertools

import pytest

from rxtrail.config import ChronicConfig
from rxtrail.plans.chronic import ChronicModel
from rxtrail.sources.derived import SAMPLE_SETS
from rxtrail.sources.staging import Staging
from tests.samples import (
    AS_OF,
    chronic_inputs,
    line,
    moment,
    patient,
    tagged_line,
    whole_tables,
)

DAY = dt.date(2000, 6, 15)
OFFSETS = [-15, -14, -8, -7, -1, 0, 1, 7, 8, 14, 15]
ILLNESS = {430, 431, 60, 207, 208, 209, 260, 261, 310, 410, 340, 360, 420, 380}
PROCEDURE_OR_ANTIBIOTIC = {430, 431, 410}
ANESTHESIA, VACCINE = {301, 302}, {16}
CALMING = {207, 208, 209, 260, 261}

BOUGHT = [274, 330, 285, 78, 400, 401, 370, 320, 321, 56, 251, 390]
TRIGGERS = [301, 16, 430, 431, 60, 207, 209, 260, 310, 410, 340, 360, 420, 380, 350, 7, 274]


def explained_nearby(bought: int, trigger: int, days: int, species: str) -> bool:
    near, exam = abs(days) <= 7, trigger == 7 and 0 <= days <= 14
    if bought in (274, 330, 320, 321):
        return near and trigger in ILLNESS
    if bought in (78, 400, 401):
        return (near and trigger in ILLNESS) or exam
    if bought == 370:
        urinalysis = species == "canine" and trigger == 60 and abs(days) <= 14
        return (near and trigger in PROCEDURE_OR_ANTIBIOTIC) or urinalysis
    return False


def explained_by_invoice(bought: int, trigger: int) -> bool:
    if bought in (274, 330, 78):
        return trigger in ANESTHESIA | VACCINE
    if bought == 285:
        return trigger in {207, 208, 209, 260, 261, 310, 350}
    if bought in (400, 401):
        return trigger in ANESTHESIA | CALMING
    if bought in (370, 320, 321):
        return trigger in ANESTHESIA
    return False


def admitted(trigger: int) -> dict:
    """Immunotherapy alone is no relevant line; under vaccines it is."""
    return {"top": 16} if trigger == 350 else {}


def model(spark, tables, **config) -> ChronicModel:
    return ChronicModel(
        chronic_inputs(spark, tables), ChronicConfig(sets=SAMPLE_SETS, as_of=AS_OF, **config), Staging(spark)
    )


def ids(frame) -> set[int]:
    return {row.transaction_odu_id for row in frame.select("transaction_odu_id").collect()}


def test_rule_matrix(spark):
    """One patient per purchase, trigger, offset and species; purchase ids are even."""
    lines, patients, nearby, by_invoice = [], [], set(), set()
    number = itertools.count(1)
    for bought, trigger, days in itertools.product(BOUGHT, TRIGGERS, OFFSETS):
        for species in ("canine", "feline") if (bought, trigger) == (370, 60) else ("feline",):
            id = next(number)
            patients.append(patient(id, species))
            # Late purchase, early trigger: only calendar days may count.
            lines.append(tagged_line(bought, id, moment(DAY, 23), 2 * id))
            when = moment(DAY + dt.timedelta(days=days), 1)
            lines.append(tagged_line(trigger, id, when, 2 * id + 1))
            if explained_nearby(bought, trigger, days, species):
                nearby.add(2 * id)
    for bought, trigger in itertools.product(BOUGHT, TRIGGERS):
        far = moment(DAY + dt.timedelta(days=40))
        for invoice, other_invoice in ((5, 5), (5, 6), (None, None)):
            id = next(number)
            patients.append(patient(id, "canine"))
            lines.append(tagged_line(bought, id, moment(DAY), 2 * id, invoice_odu_id=invoice))
            other = {"invoice_odu_id": other_invoice} | admitted(trigger)
            lines.append(tagged_line(trigger, id, far, 2 * id + 1, **other))
            if invoice == other_invoice == 5 and explained_by_invoice(bought, trigger):
                by_invoice.add(2 * id)

    run = model(spark, whole_tables(lines, patients))
    purchases = {row["transaction_odu_id"] for row in lines if row["transaction_odu_id"] % 2 == 0}
    # Triggers can be explained as well; only the purchases are asked about here.
    assert ids(run.invalid_by_window()) & purchases == nearby
    assert ids(run.invalid_by_invoice()) & purchases == by_invoice
    assert ids(run.surviving_purchases()) & purchases == purchases - nearby - by_invoice


def test_an_explained_row_takes_its_whole_purchase(spark):
    """Two lines of one purchase id: the explained one takes the other with it."""
    lines = [
        tagged_line(274, 1, moment(DAY), 100),
        tagged_line(56, 1, moment(DAY), 100),
        tagged_line(56, 1, moment(DAY), 101),
        tagged_line(410, 1, moment(DAY), 102),
        tagged_line(274, 2, moment(DAY), 100),
    ]
    run = model(spark, whole_tables(lines))
    left = {(r.patient_odu_id, r.transaction_odu_id) for r in run.surviving_purchases().collect()}
    assert left == {(1, 101), (2, 100)}


def test_universe_and_tags(spark):
    when = moment(DAY)
    kept = {
        1: (line(1, when, 1, leaf=78, l3=274), 78),  # leaf before level 3
        2: (line(1, when, 2, l3=274, top=16), 274),  # level 3 before top
        3: (line(1, when, 3, l2=410, top=430), 410),  # level 2 before top
        4: (line(1, when, 4, leaf=78, catalog_odu_id=56), 56),  # catalog before all
        5: (line(1, when, 5, leaf=350, top=16), 350),  # immunotherapy only by another arm
        6: (line(1, when, 6, leaf=78, description=None), 78),
        7: (line(1, moment("1997-07-01"), 7, leaf=7), 7),  # first moment of the horizon
    }
    dropped = [
        line(1, when, 20, leaf=350),
        line(1, when, 21, leaf=78, description="DeClined by owner"),
        line(1, when, 22, leaf=78, is_revenue=False),
        line(1, when, 23, leaf=78, is_revenue=None),
        line(1, when, 24, leaf=78, practice_odu_id=99),
        line(1, moment("2001-08-01"), 25, leaf=78),
        line(1, moment("1997-06-30", 23), 26, leaf=78),
        line(2, when, 27, leaf=78),  # a horse
        line(3, when, 28, leaf=78),  # not a known patient
        line(1, when, 29),
    ]
    lines = [row for row, _ in kept.values()] + dropped
    tables = whole_tables(lines, [patient(1), patient(2, "equine")])
    tables["catalog_tags"] += [
        tables["catalog_tags"][0] | {"catalog_odu_id": 5, "catalog_tag_odu_id": 56},
        tables["catalog_tags"][0]
        | {
            "catalog_odu_id": 5,
            "catalog_tag_odu_id": 60,
            "odu_updated_at_utc": moment("2001-01-01"),
        },
    ]
    lines.append(line(1, when, 8, catalog_odu_id=5))  # both tags: two rows
    rows = model(spark, tables).tagged_events().collect()
    found = sorted((r.transaction_odu_id, r.tag) for r in rows)
    assert found == sorted([(n, tag) for n, (_, tag) in kept.items()] + [(8, 56), (8, 60)])
    stamps = {r.tag: r.odu_updated_at_utc for r in rows if r.transaction_odu_id == 8}
    assert stamps == {56: when, 60: moment("2001-01-01")}  # the newer of line and tag


@pytest.mark.parametrize(
    "born, validators, passes",
    [
        (dt.date(1997, 12, 31), 0, True),  # year numbers 3 apart
        (dt.date(1998, 1, 1), 0, False),
        (dt.date(1998, 1, 1), 1, False),
        (dt.date(1998, 1, 1), 2, True),
        (None, 1, False),
        (None, 2, True),
    ],
)
def test_alternative_therapy_gate(spark, born, validators, passes):
    """Validators count from 12 months before to the end of the purchase's month."""
    lines = [tagged_line(320, 1, moment("2000-06-15"), 1)]
    lines += [tagged_line(274, 1, moment("1999-06-01"), 2)] * (validators > 0)
    lines += [tagged_line(251, 1, moment("2000-06-30"), 3)] * (validators > 1)
    lines += [
        tagged_line(274, 1, moment("1999-05-31"), 4),
        tagged_line(274, 1, moment("2000-07-01"), 5),
        tagged_line(370, 1, moment("2000-05-01"), 6),  # opiates validate nothing
    ]
    run = model(spark, whole_tables(lines, [patient(1, birth_date=born)]))
    (row,) = run.corroboration_count().where("rule = 'Alternative Therapies'").collect()
    assert row.validating_purchases == validators
    assert (1 in ids(run.alt_therapy_gate())) == passes


def test_an_explained_validator_still_counts(spark):
    lines = [
        tagged_line(320, 1, moment("2000-06-15"), 1),
        tagged_line(274, 1, moment("2000-01-10"), 2),
        tagged_line(410, 1, moment("2000-01-10"), 3),
    ]
    run = model(spark, whole_tables(lines))
    assert 2 in ids(run.invalid_purchases())
    (row,) = run.corroboration_count().collect()
    assert row.validating_purchases == 1


LABELS = {
    56: ("Pain Diet", 0),
    251: ("DMOAD", 0),
    390: ("Monoclonal Antibody", 0),
    274: ("NSAIDs", 2),
    285: ("Supplements", 2),
    78: ("Analgesic", 2),
    400: ("Gabapentin & Tramadol", 2),
    370: ("Opiate", 2),
    330: ("Anti-Inflammatory", None),
    320: ("Alternative Therapies", 3),
}


def test_repeat_thresholds(spark):
    """Per rule, patients with 0 to 3 other dates; a second purchase a day adds none."""
    lines, expected, number = [], {}, itertools.count(1)
    for (tag, (rule, needed)), others in itertools.product(LABELS.items(), range(4)):
        id = tag * 10 + others
        for month in range(others + 1):
            day = moment(dt.date(2000, 1 + month, 10))
            lines += [tagged_line(tag, id, day, next(number)) for _ in range(2)]
        if needed is not None and others >= needed:
            expected[id] = (rule, 0 if needed == 0 else others, 2 * (others + 1))
    found = {}
    for row in model(spark, whole_tables(lines)).chronic_purchases().collect():
        rule, purchases, rows = found.get(row.patient_odu_id, (row.rule, row.purchases, 0))
        assert (rule, purchases) == (row.rule, row.purchases)
        found[row.patient_odu_id] = (rule, purchases, rows + 1)
    assert found == expected


def test_counting_anti_inflammatories_is_an_option(spark):
    lines = [tagged_line(330, 1, moment(dt.date(2000, m, 1)), m) for m in (1, 2, 3)]
    tables = whole_tables(lines)
    assert not model(spark, tables).chronic_purchases().collect()
    counted = model(spark, tables, count_anti_inflammatory=True).chronic_purchases().collect()
    assert [row.purchases for row in counted] == [2, 2, 2]


def test_repeat_reach_and_stamp(spark):
    """Months 11 apart count, 12 apart do not; the stamp is the newest of what counted."""
    stamps = {1: "2000-01-31", 2: "2000-12-01", 3: "2001-01-01", 4: "1998-07-31"}
    lines = [
        tagged_line(274, 1, moment(day), id, odu_updated_at_utc=moment(f"2001-02-0{id}"))
        for id, day in stamps.items()
    ]
    run = model(spark, whole_tables(lines))
    rows = {r.transaction_odu_id: r for r in run.freshness_stamp().collect()}
    counts = {r.transaction_odu_id: r.purchases for r in run.repeat_purchases().collect()}
    assert counts == {1: 1, 2: 2, 3: 1}  # 4 lies before the output months
    assert rows[1].updated_at == moment("2001-02-02")
    assert rows[2].updated_at == moment("2001-02-03")
    assert rows[3].newest_at == moment("2001-02-03")  # its own is newer than 2's


def test_missing_stamp_can_win(spark):
    tables = whole_tables([tagged_line(251, 1, moment(DAY), 1)])
    (skipped,) = model(spark, tables).chronic_purchases().collect()
    (missing,) = model(spark, tables, null_stamps_win=True).chronic_purchases().collect()
    assert skipped.odu_updated_at_utc == moment(DAY) and missing.odu_updated_at_utc is None
