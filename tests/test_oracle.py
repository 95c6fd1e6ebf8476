"""Every registered query against its SQL, and the contract of the entry module."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert difference(query, sql, spark, connection, FOLDER) == ""


def test_every_query_of_the_suite_has_sql():
    for module in entry.SUITE:
        assert set(module.QUERIES) == set(module.ORACLE)


def test_entry_has_rows_and_fixed_columns(spark):
    frame = entry.entry(spark)
    assert frame.columns == [
        "p_type", "total_orders", "units_sold", "total_sales", "average_order_value",
    ]
    assert frame.count() > 0
