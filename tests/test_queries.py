"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as registered
from checks.compare import duckdb_over, rows_of_spark, rows_of_sql

SF = "/root/testdata/sf0.001"


MODELS = registered.chronic_sql.QUERIES | registered.switching_sql.QUERIES


def test_every_query_has_its_sql():
    assert MODELS.keys() <= registered.queries().keys()
    assert len(MODELS) == 25


@pytest.mark.parametrize("name", MODELS)
def test_query(spark, name):
    ours = rows_of_spark(registered.queries()[name](spark, SF))
    theirs = rows_of_sql(duckdb_over(SF), registered.oracle_sql()[name])
    assert ours == theirs
    assert ours[1]


@pytest.mark.parametrize("name", registered.chronic_sql.OTHER_WAYS)
def test_other_way(spark, name):
    test_query(spark, name)
