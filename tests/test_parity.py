"""Every registered query against its SQL text on the smallest supplied tables."""

import pytest

import __spark_entry__ as driver
from parity.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
#: The queries of the training-data subpackage have tests of their own.
QUERIES = {k: v for k, v in driver.queries().items() if k not in driver.LLM_QUERIES}
SQL = {k: v for k, v in driver.oracle_sql().items() if k not in driver.LLM_QUERIES}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = differences(QUERIES[name](spark, FOLDER), duck, SQL[name])
    assert found in ([], ["no rows"])


def test_entry(spark):
    assert driver.entry(spark).count() > 0
