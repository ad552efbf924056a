"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as contract
import oracle
from compare import database, spark_side, sql_side

SF = "/root/testdata/sf0.01"
QUERIES, SQL = contract.queries(), oracle.SQL


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    columns, rows, n = spark_side(QUERIES[name](spark, SF))
    want_columns, want_rows, want_n = sql_side(con, SQL[name])
    assert columns == want_columns
    assert n == want_n and n > 0
    assert rows == want_rows, (rows - want_rows, want_rows - rows)


def test_contract_is_complete():
    assert set(contract._QUERIES) == set(SQL)
