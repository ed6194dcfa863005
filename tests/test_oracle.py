"""Every query with an SQL twin agrees with it on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, contract.queries()[name], ORACLES[name], FOLDER) == ""


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry_has_rows(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["quality", "n"]
    assert frame.count() > 0
