"""Revenue aggregates over order lines (flat, or from ``star_lines``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.expressions import calendar_parts, cents, exact_ratio, mean, month_start, percent


def revenue() -> Column:
    return cents(F.sum("sales")).alias("revenue")


def profit() -> Column:
    return cents(F.sum("profit")).alias("profit")


def units() -> Column:
    return F.sum("quantity").cast("bigint").alias("units")


def orders() -> Column:
    return F.count_distinct("order_id").alias("orders")


def _calendar(*names: str) -> list[Column]:
    parts = calendar_parts("order_date")
    return [parts[n].alias(n) for n in names]


def monthly_revenue(lines: DataFrame, apart: bool = False) -> DataFrame:
    """Totals of each month. With ``apart`` the orders are counted in a pass of their own.

    Counting them beside the sums shuffles a row of sums per order and task;
    the second pass, worth it for stored lines, shuffles the bare order ids.
    """
    month, names = month_start("order_date").alias("_month"), ("year", "month", "month_name")
    parts = calendar_parts("_month")
    totals = [revenue(), profit(), mean("sales").alias("avg_line_value")]
    if apart:
        counted = lines.select(month, "order_id").distinct().groupBy("_month").agg(F.count("order_id").alias("orders"))
        found = lines.groupBy(month).agg(*totals).withColumnRenamed("_month", "_of")
        found = found.join(counted, F.col("_of").eqNullSafe(F.col("_month")))
    else:
        found = lines.groupBy(month).agg(*totals, orders())
    return found.select(*(parts[n].alias(n) for n in names), "revenue", "profit", "orders", "avg_line_value")


def quarterly_revenue(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_calendar("year", "quarter")).agg(revenue(), profit())


def revenue_by_category(lines: DataFrame) -> DataFrame:
    return lines.groupBy("category", "sub_category").agg(revenue(), profit(), units())


def revenue_by_region(lines: DataFrame) -> DataFrame:
    return lines.groupBy("region", "state").agg(revenue(), profit())


def product_revenue(lines: DataFrame) -> DataFrame:
    return lines.groupBy("product_id", "product_name", "category").agg(revenue(), profit(), units())


def top_products(lines: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` products with most revenue, ties by id."""
    return product_revenue(lines).orderBy(F.desc("revenue"), "product_id").limit(n)


def bottom_products(lines: DataFrame, n: int = 100) -> DataFrame:
    """The ``n`` products with least profit, ties by id."""
    return product_revenue(lines).orderBy("profit", "product_id").limit(n)


def revenue_by(lines: DataFrame, *dimensions: str) -> DataFrame:
    """Revenue by any columns; NULL is a group of its own."""
    return lines.groupBy(*dimensions).agg(revenue())


def revenue_by_each(lines: DataFrame, *dimensions: str) -> DataFrame:
    """(dimension, value, revenue): revenue by each column by itself, in one pass over the lines."""
    cells = F.inline(F.array(*(
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
        for d in dimensions
    )))
    return revenue_by(lines.select("sales", cells), "dimension", "value")


def executive_kpi(lines: DataFrame) -> DataFrame:
    """One row of totals, average order value and profit margin."""
    earned, gained, count = F.col("earned"), F.col("gained"), F.col("orders")
    totals = lines.agg(F.sum("sales").alias("earned"), F.sum("profit").alias("gained"), orders())
    return totals.select(
        cents(earned).alias("total_revenue"),
        cents(gained).alias("total_profit"),
        count.alias("total_orders"),
        exact_ratio(earned, count).alias("avg_order_value"),
        percent(gained, earned).alias("profit_margin_pct"),
    )


def kpi_by_category(categories: DataFrame) -> DataFrame:
    """The category table summed over its sub-categories."""
    amount = "decimal(18,2)"
    return categories.groupBy("category").agg(
        cents(F.sum(F.col("revenue").cast(amount))).alias("revenue"),
        cents(F.sum(F.col("profit").cast(amount))).alias("profit"),
        F.sum("units").cast("bigint").alias("units"),
    )


def kpi_cards(monthly: DataFrame) -> DataFrame:
    """Totals over the monthly table, as one row."""
    return monthly.agg(*_monthly_totals(), F.sum("orders").alias("orders"))


def yearly_trend(monthly: DataFrame) -> DataFrame:
    return monthly.groupBy("year").agg(*_monthly_totals())


def _monthly_totals() -> list[Column]:
    return [cents(F.sum(F.col(c).cast("decimal(18,2)"))).alias(c) for c in ("revenue", "profit")]


def chart_series(df: DataFrame, dimension: str, metric: str, limit: int | None = None) -> DataFrame:
    """A chart's bars: the metric summed by one dimension, largest first; all unless ``limit`` is given."""
    total = cents(F.sum(F.col(metric).cast("decimal(18,2)"))).alias(metric)
    bars = df.groupBy(dimension).agg(total).orderBy(F.desc(metric), dimension)
    return bars if limit is None else bars.limit(limit)


def chart_pivot(df: DataFrame, index: str, across: str, metric: str) -> DataFrame:
    """The mean of the metric by ``index``, with one column per value of ``across`` that occurs."""
    return df.groupBy(index).pivot(across).agg(F.round(F.avg(F.col(metric)), 2))


def category_totals(lines: DataFrame) -> DataFrame:
    """Sales, profit and line count by category, as checked after ingestion."""
    return lines.groupBy("category").agg(
        cents(F.sum("sales")).alias("sales"), profit(), F.count(F.lit(1)).alias("lines")
    )


def date_range(lines: DataFrame) -> DataFrame:
    return lines.agg(
        F.min("order_date").alias("first_order"), F.max("order_date").alias("last_order")
    )
