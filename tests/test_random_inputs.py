"""Both models against their SQL on untidy random inputs, with and without hot keys."""

import pytest

from checks import chronic_sql, switching_sql
from checks.compare import rows_of_spark, rows_of_sql
from rxtrail.config import ChronicConfig, SkewLimits, SwitchConfig
from rxtrail.operators.invalidation import INVOICE, PURCHASE
from rxtrail.operators.islands import STEP
from rxtrail.operators.skew import find_hot_keys
from rxtrail.operators.switching import ITEM
from rxtrail.plans.chronic import ChronicModel
from rxtrail.plans.switching import SwitchModel
from rxtrail.sources.derived import SAMPLE_SETS
from rxtrail.sources.staging import Staging
from tests import samples

# Everything from 3 rows on is hot; dimensions are never broadcast.
TINY = SkewLimits(hot_rows=3, broadcast_rows=0)

CHRONIC = [
    "pain_universe",
    "practice_whitelist",
    "tag_assignment",
    "tagged_events",
    "invalid_by_invoice",
    "invalid_by_window",
    "surviving_purchases",
    "corroboration_count",
    "alt_therapy_gate",
    "repeat_purchases",
    "freshness_stamp",
    "chronic_purchases",
]
SWITCHING = [
    "same_day_combos",
    "previous_purchase_date",
    "switch_pairs",
    "product_islands",
    "island_lengths",
    "nsaid_switching",
]


def check(frame, connection, sql):
    columns, ours = rows_of_spark(frame)
    sql_columns, theirs = rows_of_sql(connection, sql)
    assert columns == sql_columns
    assert not ours - theirs, list((ours - theirs).items())[:3]
    assert not theirs - ours, list((theirs - ours).items())[:3]
    assert ours


@pytest.mark.parametrize("skew", [SkewLimits(), TINY], ids=["plain", "hot"])
@pytest.mark.parametrize("seed", [1, 2])
def test_chronic(spark, seed, skew):
    tables = samples.random_chronic_tables(seed)
    connection = samples.chronic_in_duckdb(tables)
    config = ChronicConfig(sets=SAMPLE_SETS, as_of=samples.AS_OF, skew=skew)
    model = ChronicModel(samples.chronic_inputs(spark, tables), config, Staging(spark))
    assert (model.hot_patients is None) == (skew is not TINY)
    for stage in CHRONIC:
        check(getattr(model, stage)(), connection, chronic_sql.over_tables(stage))
    assert not model.survivors().where("several_dates").isEmpty()
    if skew is TINY:
        for keys in (INVOICE, PURCHASE):
            assert find_hot_keys(model.judged, keys, TINY, model.staging)


@pytest.mark.parametrize("skew", [SkewLimits(), TINY], ids=["plain", "hot"])
@pytest.mark.parametrize("seed", [1, 2])
def test_switching(spark, seed, skew):
    rows = samples.random_purchases(seed)
    connection = samples.purchases_in_duckdb(rows)
    model = SwitchModel(
        samples.purchases_frame(spark, rows), SwitchConfig(skew=skew), Staging(spark)
    )
    assert (model.hot_patients is None) == (skew is not TINY)
    for stage in SWITCHING:
        check(getattr(model, stage)(), connection, switching_sql.over_tables(stage))
    if skew is TINY:
        assert model.hot(ITEM)
        assert model.hot(STEP)
