"""Dimensions, the fact and its joins on small hand-made lines."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymill.operators import quality, sales, star

SCHEMA = (
    "row_id bigint, order_id string, order_date date, ship_date date, ship_mode string,"
    " customer_id string, customer_name string, segment string, country string, city string,"
    " state string, postal_code string, region string, product_id string, category string,"
    " sub_category string, product_name string, sales decimal(12,4), quantity bigint,"
    " discount decimal(5,4), profit decimal(12,4)"
)
D = dt.date


def line(row, day, ship, customer=("C1", "Ann", "Home"), code="100", amount=10):
    from decimal import Decimal
    return (
        row, "O1", day, ship, "Slow", *customer, "X", "Y", "Z", code, "W",
        "P1", "Cat", "Sub", "Pen", Decimal(amount), 1, Decimal(0), Decimal(1),
    )


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame([
        line(1, D(2024, 1, 1), D(2024, 1, 3)),
        line(2, D(2024, 1, 5), None, code=None),
        line(3, D(2024, 1, 9), D(2024, 2, 1), customer=("C1", "Abe", "Office")),
        line(4, D(2024, 1, 9), D(2024, 1, 9), customer=("C2", None, "Home"), code=None),
    ], SCHEMA)


@pytest.fixture(scope="module")
def dims(lines):
    return (
        star.dim_customer(lines), star.dim_product(lines), star.dim_region(lines),
        star.dim_ship_mode(lines),
    )


def test_conflicting_attributes_keep_the_smallest(dims):
    rows = [tuple(r) for r in dims[0].orderBy("customer_key").collect()]
    assert rows == [(1, "C1", "Abe", "Office"), (2, "C2", None, "Home")]


def test_missing_postal_code_is_a_place(dims):
    assert [r["postal_code"] for r in dims[2].orderBy("region_key").collect()] == [None, "100"]


def test_fact_keeps_every_line(lines, dims):
    fact = star.fact_sales(lines, *dims)
    rows = {r["row_id"]: r for r in fact.collect()}
    assert len(rows) == 4
    assert rows[2]["ship_date_key"] is None and rows[3]["ship_date_key"] == 20240201
    assert rows[2]["region_key"] == rows[4]["region_key"] == 1
    assert rows[1]["order_year"] == 2024


def test_order_calendar_leaves_later_ship_dates_without_key(lines, dims):
    fact = star.fact_sales(lines, *dims, cover="order")
    keys = {r["row_id"]: r["ship_date_key"] for r in fact.collect()}
    assert keys == {1: 20240103, 2: None, 3: None, 4: 20240109}


def test_calendar_covers_both_dates(lines):
    days = star.dim_date(lines)
    row = days.agg(F.count("*"), F.min("date_key"), F.max("date_key")).first()
    assert tuple(row) == (32, 20240101, 20240201)
    assert star.dim_date(lines, "order").count() == 9
    assert quality.calendar_continuous(days, "d").first()["passed"]


def test_star_lines_give_the_flat_result(lines, dims):
    fact = star.fact_sales(lines, *dims)
    again = star.star_lines(fact, star.dim_date(lines), *dims[:3])
    for aggregate in (sales.monthly_revenue, sales.revenue_by_category, sales.revenue_by_region):
        assert sorted(aggregate(again).collect()) == sorted(aggregate(lines).collect())


def test_lines_without_order_date_are_left_out(spark, lines, dims):
    undated = lines.withColumn("order_date", F.when(F.col("row_id") > 1, F.col("order_date")))
    assert star.fact_sales(undated, *dims).count() == 3


def test_insert_if_absent_adds_only_new_keys(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    rows = spark.createDataFrame([(1, "z"), (2, "c"), (2, "b"), (None, "m")], "k int, v string")
    merged = star.insert_if_absent(target, rows, "k")
    assert sorted(map(tuple, merged.collect()), key=repr) == [(1, "a"), (2, "b"), (None, "n")]


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (1,), (9,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "k int")
    assert [r["k"] for r in star.orphans(fact, dim, "k").collect()] == [9]
    found = quality.referential_integrity(fact, "k", dim, "fact").first()
    assert (found["failures"], found["passed"]) == (1, False)
