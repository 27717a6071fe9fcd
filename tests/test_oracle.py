"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, difference
from checks.oracle import oracle
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.count() > 0 and "covid_related" in result.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    assert difference(QUERIES[name](spark, sf_dir), duck, oracle()[name]) is None
