"""Every catalog query equals its SQL on the smallest tables."""

import pytest
from oracle import difference, duckdb_tables
from sample import SF_SMALL

import __spark_entry__ as contract
from tripstar.plans import catalog, oracle_sql


@pytest.fixture(scope="module")
def tables():
    return duckdb_tables(SF_SMALL)


def test_same_keys():
    assert set(catalog.all_queries()) == set(oracle_sql.all_sql())
    assert set(catalog.all_queries()) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query_equals_sql(spark, tables, name):
    df = contract.queries()[name](spark, SF_SMALL)
    assert difference(df, tables, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() == 5
