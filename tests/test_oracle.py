"""Every registered query against its SQL, on the smallest scale."""

import pytest
from oracle_check import connect, differences

import __spark_entry__ as contract
from tidewire.plans.oracle import ORACLE
from tidewire.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_registry_is_complete():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    assert differences(spark, duck, SF, contract.queries()[name], contract.oracle_sql()[name]) is None


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.count() > 0
    assert rows.columns[:3] == ["logical_date", "rank", "score"]
