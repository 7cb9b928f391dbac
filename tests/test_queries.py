"""Every registered query against its SQL counterpart."""

import pytest
from compare import spark_side, sql_side
from conftest import SMALL

import __spark_entry__ as entry_point
from cohortloom.plans.registry import QUERIES
from oracles.sql import ORACLES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    columns, rows = spark_side(QUERIES[name](spark, SMALL))
    sql_columns, sql_rows = sql_side(connection, ORACLES[name])
    assert columns == sql_columns
    assert rows == sql_rows
    assert sum(rows.values()) > 0


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert len(rows) == 12
    assert {r["dia_postop"] for r in rows} == {1, 3, 7, 14}
