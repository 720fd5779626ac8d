"""Every query against its SQL counterpart on the smallest tables."""

import pytest
from compare import connect, mismatch

import __spark_entry__ as driver
from orderloom.plans.oracle import all_oracles
from orderloom.plans.queries import all_queries

SF = "/root/testdata/sf0.001"

@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_names_match():
    assert set(all_queries()) == set(all_oracles())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query(spark, con, name):
    assert mismatch(driver.queries()[name](spark, SF), con, all_oracles()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0
