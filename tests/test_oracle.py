"""Every registered query against its DuckDB oracle (values and column names)."""

import os

import pytest

import __spark_entry__ as entry
from ledgerlake import catalog, oracle
from tests.oracle_compare import compare, duck_connection

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
SQL = oracle.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert res["names_match"], res
    assert res["values_match"], res
    assert not res["type_diffs"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
