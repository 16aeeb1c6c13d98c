"""Every registered query against its DuckDB statement on the smallest data set."""

import pytest

import __spark_entry__ as contract
from ledgerloom.catalog import QUERIES
from oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    return connect(FOLDER)


def test_every_query_has_a_statement():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    compare(contract.queries()[name](spark, FOLDER), con, contract.oracle_sql()[name])


def test_entry(spark):
    assert contract.entry(spark).count() > 0
