"""Every named query against its SQL, and the shape of those without one."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
import compare

QUERIES, SQL = contract.queries(), contract.oracle_sql()
# the text queries are tested in tests/llm; the last two fit the model of forecast_gbt again
ELSEWHERE = re.compile(r"op\d+_|pipeline$|compare_models$|sales_forecast$")


@pytest.fixture(scope="module")
def duck(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, folder, duck, name):
    assert compare.difference(QUERIES[name](spark, folder), duck, SQL[name]) is None


@pytest.mark.parametrize("name", [q for q in sorted(set(QUERIES) - set(SQL)) if not ELSEWHERE.match(q)])
def test_query_without_sql_gives_rows(spark, folder, name):
    assert not QUERIES[name](spark, folder).isEmpty()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_has_a_row_per_month(spark):
    months = contract.entry(spark).select("year", "month").collect()
    assert len(months) == len(set(months)) > 70
