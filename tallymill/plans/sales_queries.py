"""Queries on revenue, products, places and their growth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.expressions import cents, ratio
from tallymill.operators import kpis, marts, sales
from tallymill.plans.registry import Source, query
from tallymill.plans.sql_views import half_up

MONEY = ("sales", "profit")


def monthly(s: Source) -> DataFrame:
    return sales.monthly_revenue(s.lines("order_id", "order_date", *MONEY))


def categories(s: Source) -> DataFrame:
    return sales.revenue_by_category(s.lines("category", "sub_category", *MONEY, "quantity"))


def places(s: Source) -> DataFrame:
    return sales.revenue_by_region(s.lines("region", "state", *MONEY))


def product_lines(s: Source) -> DataFrame:
    return s.lines("product_id", "product_name", "category", *MONEY, "quantity")


def doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Decimal columns as doubles, the form the SQL side serves."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


query("monthly_revenue", "SELECT * FROM months")(monthly)
query("revenue_by_category", "SELECT * FROM categories")(categories)
query("revenue_by_region", "SELECT * FROM places")(places)

query("product_revenue", "SELECT * FROM products")(
    lambda s: sales.product_revenue(product_lines(s)))

TOP = "SELECT * FROM products ORDER BY revenue DESC, product_id LIMIT {}"
query("top_products", TOP.format(100))(lambda s: sales.top_products(product_lines(s)))
query("top_n", TOP.format(25))(lambda s: sales.top_products(product_lines(s), 25))
query("head_n", """
    SELECT product_name, cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines GROUP BY product_name ORDER BY revenue DESC, product_name LIMIT 15
""")(lambda s: sales.revenue_by(s.lines("product_name", "sales"), "product_name")
     .orderBy(F.desc("revenue"), "product_name").limit(15))

query("executive_kpi", f"""
    SELECT cast(round(sum(sales), 2) AS double) AS total_revenue,
        cast(round(sum(profit), 2) AS double) AS total_profit,
        count(DISTINCT order_id) AS total_orders,
        {half_up('sum(sales)', 'count(DISTINCT order_id)')} AS avg_order_value,
        round(100.0 * (cast(sum(profit) AS double) / nullif(cast(sum(sales) AS double), 0)), 2)
            AS profit_margin_pct
    FROM sales_lines
""")(lambda s: sales.executive_kpi(s.lines("order_id", *MONEY)))

query("kpi_by_category", """
    SELECT category, cast(sum(cast(revenue AS decimal(18,2))) AS double) AS revenue,
        cast(sum(cast(profit AS decimal(18,2))) AS double) AS profit,
        cast(sum(units) AS bigint) AS units
    FROM categories GROUP BY category
""")(lambda s: sales.kpi_by_category(categories(s)))

query("kpi_cards", """
    SELECT cast(sum(cast(revenue AS decimal(18,2))) AS double) AS revenue,
        cast(sum(cast(profit AS decimal(18,2))) AS double) AS profit,
        cast(sum(orders) AS bigint) AS orders FROM months
""")(lambda s: sales.kpi_cards(monthly(s)))

query("yearly_trend", """
    SELECT year, cast(sum(cast(revenue AS decimal(18,2))) AS double) AS revenue,
        cast(sum(cast(profit AS decimal(18,2))) AS double) AS profit
    FROM months GROUP BY year
""")(lambda s: sales.yearly_trend(monthly(s)))

query("chart_revenue_by_category", """
    SELECT category, cast(sum(cast(revenue AS decimal(18,2))) AS double) AS revenue
    FROM categories GROUP BY category ORDER BY revenue DESC, category
""")(lambda s: sales.chart_series(categories(s), "category", "revenue"))
query("chart_revenue_by_region", """
    SELECT region, cast(sum(cast(revenue AS decimal(18,2))) AS double) AS revenue
    FROM places GROUP BY region ORDER BY revenue DESC, region
""")(lambda s: sales.chart_series(places(s), "region", "revenue"))
query("chart_revenue_by_product", """
    SELECT product_name, cast(sum(cast(revenue AS decimal(18,2))) AS double) AS revenue
    FROM (SELECT * FROM products ORDER BY revenue DESC, product_id LIMIT 100)
    GROUP BY product_name ORDER BY revenue DESC, product_name
""")(lambda s: sales.chart_series(
    sales.top_products(product_lines(s)), "product_name", "revenue"))

query("chart_pivot", """
    SELECT state,
        round(avg(CASE WHEN region = 'AFRICA' THEN revenue END), 2) AS "AFRICA",
        round(avg(CASE WHEN region = 'AMERICA' THEN revenue END), 2) AS "AMERICA",
        round(avg(CASE WHEN region = 'ASIA' THEN revenue END), 2) AS "ASIA",
        round(avg(CASE WHEN region = 'EUROPE' THEN revenue END), 2) AS "EUROPE",
        round(avg(CASE WHEN region = 'MIDDLE EAST' THEN revenue END), 2) AS "MIDDLE EAST"
    FROM places GROUP BY state
""")(lambda s: sales.chart_pivot(
    places(s), "state", "region", "revenue"))

query("bronze_category_summary", """
    SELECT category, cast(round(sum(sales), 2) AS double) AS sales,
        cast(round(sum(profit), 2) AS double) AS profit, count(*) AS lines
    FROM sales_lines GROUP BY category
""")(lambda s: sales.category_totals(s.lines("category", *MONEY)))

query("date_range", """
    SELECT min(order_date) AS first_order, max(order_date) AS last_order FROM sales_lines
""")(lambda s: sales.date_range(s.lines("order_date")))

query("monthly_revenue_projection", """
    SELECT year, month, month_name, revenue, profit, orders FROM months ORDER BY year, month
""")(lambda s: monthly(s).drop("avg_line_value").orderBy("year", "month"))

query("sort_multi", "SELECT * FROM categories ORDER BY revenue DESC, category, sub_category")(
    lambda s: categories(s).orderBy(F.desc("revenue"), "category", "sub_category"))

query("sample_rows", """
    SELECT order_id, row_id, order_date, customer_id, cast(sales AS double) AS sales
    FROM sales_lines ORDER BY order_id, row_id LIMIT 5
""")(lambda s: doubles(
    s.lines("order_id", "row_id", "order_date", "customer_id", "sales")
    .orderBy("order_id", "row_id").limit(5), "sales"))

query("lag_yoy", """
    SELECT year, year_revenue, lag(year_revenue) OVER (ORDER BY year) AS prev_year_revenue,
        round(100.0 * ((year_revenue - lag(year_revenue) OVER (ORDER BY year))
            / nullif(lag(year_revenue) OVER (ORDER BY year), 0)), 2) AS yoy_growth_pct
    FROM (SELECT year, cast(sum(cast(revenue AS decimal(18,2))) AS double) AS year_revenue
          FROM months GROUP BY year)
""")(lambda s: kpis.year_over_year(monthly(s)))

EXECUTIVE_SQL = """
    SELECT *, lag(year_revenue) OVER (ORDER BY year) AS prev_year_revenue,
        round(100.0 * ((year_revenue - lag(year_revenue) OVER (ORDER BY year))
            / nullif(lag(year_revenue) OVER (ORDER BY year), 0)), 2) AS yoy_growth_pct
    FROM (
        SELECT year, cast(r AS double) AS year_revenue, cast(p AS double) AS year_profit,
            round(100.0 * (cast(p AS double) / nullif(cast(r AS double), 0)), 2)
                AS profit_margin_pct,
            round(cast(r AS double) / nullif(cast(p AS double), 0), 6) AS revenue_to_profit,
            months_reported
        FROM (SELECT year, sum(cast(revenue AS decimal(18,2))) AS r,
                  sum(cast(profit AS decimal(18,2))) AS p, count(*) AS months_reported
              FROM months GROUP BY year))
"""
query("mart_executive_kpis", EXECUTIVE_SQL)(lambda s: marts.executive_kpis(monthly(s)))

query("stg_monthly_revenue", "SELECT * FROM months")(
    lambda s: doubles(marts.stage(monthly(s), "monthly_revenue"),
                      "revenue", "profit", "avg_line_value"))
query("stg_revenue_by_category", "SELECT * FROM categories")(
    lambda s: doubles(marts.stage(categories(s), "revenue_by_category"), "revenue", "profit"))
query("stg_revenue_by_region", "SELECT * FROM places")(
    lambda s: doubles(marts.stage(places(s), "revenue_by_region"), "revenue", "profit"))
query("stg_top_products", """
    SELECT cast(product_id AS varchar) AS product_id, product_name, category, revenue, profit, units
    FROM products ORDER BY revenue DESC, products.product_id LIMIT 100
""")(lambda s: doubles(
    marts.stage(sales.top_products(product_lines(s)), "top_products"), "revenue", "profit"))

query("kpi_avg_discount", f"""
    SELECT {half_up('sum(discount)', 'count(*)', 6)} AS avg_discount FROM sales_lines
""")(lambda s: kpis.average_discount(s.lines("discount")))

query("kpi_mom_growth", """
    SELECT year, month, revenue, lag(revenue) OVER (ORDER BY year, month) AS prev_revenue,
        round(100.0 * ((revenue - lag(revenue) OVER (ORDER BY year, month))
            / nullif(lag(revenue) OVER (ORDER BY year, month), 0)), 2) AS mom_growth_pct
    FROM months
""")(lambda s: kpis.month_over_month(monthly(s)))

query("kpi_yoy_growth", """
    SELECT year, prev_year_revenue, yoy_growth_pct FROM (
        SELECT year, lag(r) OVER (ORDER BY year) AS prev_year_revenue,
            round(100.0 * ((r - lag(r) OVER (ORDER BY year))
                / nullif(lag(r) OVER (ORDER BY year), 0)), 2) AS yoy_growth_pct
        FROM (SELECT year, cast(sum(cast(revenue AS decimal(18,2))) AS double) AS r
              FROM months GROUP BY year))
""")(lambda s: kpis.year_over_year(monthly(s)).drop("year_revenue"))

query("kpi_profit_by_category", "SELECT category, sub_category, profit FROM categories")(
    lambda s: kpis.profit_by_category(s.lines("category", "sub_category", "profit")))
query("kpi_bottom_products", """
    SELECT * FROM products ORDER BY profit, product_id LIMIT 100
""")(lambda s: sales.bottom_products(product_lines(s)))

query("kpi_discount_sensitivity", """
    SELECT product_id, lines,
        CASE WHEN corr_quantity = 0 THEN 0.0 ELSE corr_quantity END AS corr_quantity,
        CASE WHEN quantity_slope = 0 THEN 0.0 ELSE quantity_slope END AS quantity_slope,
        CASE WHEN profit_slope = 0 THEN 0.0 ELSE profit_slope END AS profit_slope
    FROM (SELECT product_id, n AS lines,
        round(cast(n * xy - x * y AS double)
            / nullif(sqrt(cast(n * xx - x * x AS double))
                * sqrt(cast(n * yy - y * y AS double)), 0), 4) AS corr_quantity,
        round(cast(n * xy - x * y AS double)
            / nullif(cast(n * xx - x * x AS double), 0) * 10000, 2) AS quantity_slope,
        round(cast(n * xz - x * z AS double)
            / nullif(cast(n * xx - x * x AS double), 0), 2) AS profit_slope
    FROM (SELECT product_id, count(*) AS n, sum(x) AS x, sum(y) AS y, sum(z) AS z,
              sum(x * x) AS xx, sum(y * y) AS yy, sum(x * y) AS xy, sum(x * z) AS xz
          FROM (SELECT product_id, cast(discount * 10000 AS bigint) AS x, quantity AS y,
                    cast(profit * 10000 AS bigint) AS z FROM sales_lines)
          GROUP BY product_id))
""")(lambda s: kpis.discount_sensitivity(s.lines("product_id", "discount", "quantity", "profit")))

query("kpi_revenue_by_segment", """
    SELECT segment, cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines GROUP BY segment
""")(lambda s: sales.revenue_by(s.lines("segment", "sales"), "segment"))
query("kpi_revenue_by_city", """
    SELECT city, cast(round(sum(sales), 2) AS double) AS revenue FROM sales_lines GROUP BY city
""")(lambda s: sales.revenue_by(s.lines("city", "sales"), "city"))
query("kpi_margin_by_region", """
    SELECT region, cast(round(sum(sales), 2) AS double) AS revenue,
        cast(round(sum(profit), 2) AS double) AS profit,
        round(100.0 * (cast(sum(profit) AS double) / nullif(cast(sum(sales) AS double), 0)), 2)
            AS margin_pct
    FROM sales_lines GROUP BY region
""")(lambda s: kpis.margin_by_region(s.lines("region", *MONEY)))
query("kpi_quarterly_trend", """
    SELECT cast(year(order_date) AS int) AS year, cast(quarter(order_date) AS int) AS quarter,
        cast(round(sum(sales), 2) AS double) AS revenue,
        cast(round(sum(profit), 2) AS double) AS profit
    FROM sales_lines GROUP BY 1, 2
""")(lambda s: sales.quarterly_revenue(s.lines("order_date", *MONEY)))
query("kpi_seasonality_index", f"""
    SELECT month, {half_up('sum(cast(revenue AS decimal(18,2)))', 'count(*)')} AS avg_revenue,
        round(avg(revenue) / (SELECT avg(revenue) FROM months), 4) AS seasonality_index
    FROM months GROUP BY month
""")(lambda s: kpis.seasonality_index(monthly(s)))
query("kpi_dead_stock", """
    SELECT product_id, max(order_date) AS last_order,
        cast(date_diff('day', max(order_date), (SELECT max(order_date) FROM sales_lines)) AS int)
            AS days_since
    FROM sales_lines GROUP BY product_id
    HAVING date_diff('day', max(order_date), (SELECT max(order_date) FROM sales_lines)) > 90
""")(lambda s: kpis.dead_stock(s.lines("product_id", "order_date")))

query("fn_safe_divide", """
    SELECT category, sub_category,
        round(revenue / nullif(units, 0), 4) AS revenue_per_unit,
        coalesce(round(profit / nullif(revenue, 0), 4), 0) AS margin
    FROM categories
""")(lambda s: categories(s).select(
    "category", "sub_category",
    F.round(ratio(F.col("revenue"), F.col("units")), 4).alias("revenue_per_unit"),
    F.coalesce(F.round(ratio(F.col("profit"), F.col("revenue")), 4), F.lit(0.0)).alias("margin"),
))
query("fn_round_currency", """
    SELECT order_id, row_id, cast(round(profit, 2) AS double) AS profit_2dp,
        cast(round(profit, 1) AS double) AS profit_1dp FROM sales_lines
""")(lambda s: s.lines("order_id", "row_id", "profit").select(
    "order_id", "row_id", cents("profit").alias("profit_2dp"),
    cents("profit", 1).alias("profit_1dp")))
