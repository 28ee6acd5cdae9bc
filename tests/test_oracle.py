"""Every query against its SQL on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SF_DIR)


def test_every_query_has_its_sql():
    assert set(driver.QUERIES) == set(driver.SQL)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_same_rows(spark, con, name):
    query, sql = driver.queries()[name], driver.oracle_sql()[name]
    assert oracle.differences(spark, con, SF_DIR, query, sql) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
