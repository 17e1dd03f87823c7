"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from tests.compare import duck, duck_rows, spark_rows
from tillroll.plans import catalog, oracles

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    columns, rows = spark_rows(QUERIES[name](spark, FOLDER))
    wanted_columns, wanted = duck_rows(con, ORACLES[name])
    assert columns == wanted_columns
    assert rows == wanted


def test_entry_points_hold_all_of_them():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
