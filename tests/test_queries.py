"""Every query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as driver
from statline.catalog import oracle
from statline.catalog.queries import QUERIES
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


def test_driver_has_every_query():
    assert set(QUERIES) <= set(driver.queries()) and set(SQL) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    found, rows = difference(QUERIES[name](spark, FOLDER), con, SQL[name])
    assert found is None
    assert rows > 0 or con.execute(SQL[name]).fetchall() == []


def test_entry(spark):
    view = driver.entry(spark)
    assert len(view.columns) == 46 and not view.isEmpty()
