"""Queries of the subpackage that SQL can express, next to their SQL."""

import pytest

from compare import database, spark_side, sql_side
from feedmetrics.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    columns, rows, n = spark_side(queries.QUERIES[name](spark, SF))
    want_columns, want_rows, want_n = sql_side(database(SF), queries.SQL[name])
    assert columns == want_columns
    assert n == want_n and n > 0
    assert rows == want_rows
