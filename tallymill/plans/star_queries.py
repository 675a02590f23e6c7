"""Queries on the star schema: dimensions, keys, the fact and its joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.expressions import calendar_parts, date_key
from tallymill.operators import sales, star
from tallymill.plans.registry import Source, query
from tallymill.session import stored

CUSTOMER = ("customer_id", "customer_name", "segment")
PRODUCT = ("product_id", "product_name", "category", "sub_category")
DATES = ("order_date", "ship_date")


def customers(s: Source) -> DataFrame:
    return star.dim_customer(s.lines(*CUSTOMER))


def products(s: Source) -> DataFrame:
    return star.dim_product(s.lines(*PRODUCT))


def regions(s: Source) -> DataFrame:
    return star.dim_region(s.lines(*star.PLACE))


def ship_modes(s: Source) -> DataFrame:
    return star.dim_ship_mode(s.lines("ship_mode"))


def calendar(s: Source) -> DataFrame:
    return star.dim_date(s.lines(*DATES))


def served(fact: DataFrame) -> DataFrame:
    """The fact with its amounts as doubles."""
    return fact.withColumns({
        c: F.col(c).cast("double") for c in ("sales", "discount", "profit")
    })


query("dim_customer", "SELECT * FROM dim_customer_sql")(customers)
query("dim_product", "SELECT * FROM dim_product_sql")(products)
query("dim_region", "SELECT * FROM dim_region_sql")(regions)
query("dim_ship_mode", "SELECT * FROM dim_ship_mode_sql")(ship_modes)
query("dim_date", "SELECT * FROM dim_date_sql")(calendar)


@query("surrogate_key", """
    SELECT cast(row_number() OVER (ORDER BY o_orderkey) AS int) AS order_key, o_orderkey AS order_id
    FROM orders
""")
def surrogate_key(s: Source) -> DataFrame:
    orders = s.table("orders").select(F.col("o_orderkey").alias("order_id"))
    return star.surrogate_key(orders, "order_key", "order_id")


FACT_COLUMNS = (
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "product_id",
    *star.PLACE, *star.MEASURES,
)


def lines_and_keys(s: Source) -> tuple[DataFrame, ...]:
    """The lines and the four dimensions that give them keys, for ``fact_sales``.

    The lines are joined, numbered and written once, with what the fact and the
    dimensions need; the dimensions then read their own columns of that table.
    """
    attributes = dict.fromkeys((*FACT_COLUMNS, *CUSTOMER, *PRODUCT))
    lines = stored(s.lines(*attributes), "lines")
    dimensions = (star.dim_customer(lines), star.dim_product(lines), star.dim_region(lines), star.dim_ship_mode(lines))
    return lines.select(*FACT_COLUMNS), *dimensions


@query("fact_build", "SELECT * FROM fact_sql")
def fact_build(s: Source) -> DataFrame:
    return served(star.fact_sales(*lines_and_keys(s)))


@query("fact_build_order_calendar", """
    SELECT order_id, row_id, order_date_key,
        CASE WHEN ship_date_key BETWEEN (SELECT min(order_date_key) FROM fact_sql)
            AND (SELECT max(order_date_key) FROM fact_sql) THEN ship_date_key END AS ship_date_key
    FROM fact_sql
""")
def fact_build_order_calendar(s: Source) -> DataFrame:
    fact = star.fact_sales(
        *lines_and_keys(s), cover="order"
    )
    return fact.select("order_id", "row_id", "order_date_key", "ship_date_key")


@query("star_monthly_revenue", "SELECT * FROM months")
def star_monthly_revenue(s: Source) -> DataFrame:
    fact = star.fact_sales(*lines_and_keys(s))
    return sales.monthly_revenue(star.star_lines(fact, calendar=calendar(s)))


@query("join_inner_single_key", """
    SELECT ship_mode_key, count(*) AS lines, cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines JOIN dim_ship_mode_sql USING (ship_mode) GROUP BY ship_mode_key
""")
def join_inner_single_key(s: Source) -> DataFrame:
    joined = s.lines("ship_mode", "sales").join(ship_modes(s), "ship_mode")
    return joined.groupBy("ship_mode_key").agg(
        F.count(F.lit(1)).alias("lines"), sales.revenue()
    )


@query("join_inner_composite_key", """
    SELECT region_key, count(*) AS lines, cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines JOIN dim_region_sql USING (country, region, state, city, postal_code)
    GROUP BY region_key
""")
def join_inner_composite_key(s: Source) -> DataFrame:
    """The plain composite join: places without a postal code find no match."""
    joined = s.lines(*star.PLACE, "sales").join(regions(s), list(star.PLACE))
    return joined.groupBy("region_key").agg(F.count(F.lit(1)).alias("lines"), sales.revenue())


@query("join_null_safe", """
    SELECT region_key, count(*) AS lines, cast(round(sum(sales), 2) AS double) AS revenue
    FROM fact_sql GROUP BY region_key
""")
def join_null_safe(s: Source) -> DataFrame:
    """The null-safe composite join keeps every line."""
    lines, places = s.lines(*star.PLACE, "sales"), regions(s)
    match = F.lit(True)
    for c in star.PLACE:
        match = match & lines[c].eqNullSafe(places[c])
    joined = lines.join(places, match)
    return joined.groupBy("region_key").agg(F.count(F.lit(1)).alias("lines"), sales.revenue())


@query("join_on_expression", """
    SELECT d.date_key, count(*) AS lines, cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines JOIN dim_date_sql d ON order_date = d.full_date GROUP BY d.date_key
""")
def join_on_expression(s: Source) -> DataFrame:
    lines = s.lines("order_date", "sales").withColumn("text", F.col("order_date").cast("string"))
    days = calendar(s)
    joined = lines.join(days, F.to_date(lines["text"]) == days["full_date"])
    return joined.groupBy("date_key").agg(F.count(F.lit(1)).alias("lines"), sales.revenue())


@query("join_left_outer", """
    SELECT CASE WHEN d.full_date <= (SELECT max(order_date) FROM sales_lines)
            AND d.full_date >= (SELECT min(order_date) FROM sales_lines)
        THEN d.date_key END AS ship_date_key, count(*) AS lines
    FROM sales_lines LEFT JOIN dim_date_sql d ON ship_date = d.full_date GROUP BY 1
""")
def join_left_outer(s: Source) -> DataFrame:
    """Ship dates against the order-date calendar; later ones get no key."""
    days = star.dim_date(s.lines("order_date"), cover="order").select("full_date", "date_key")
    lines = s.lines("ship_date")
    joined = lines.join(days, lines["ship_date"] == days["full_date"], "left")
    return joined.groupBy(F.col("date_key").alias("ship_date_key")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query("join_fact_dim_rename", """
    SELECT d.year, d.quarter, cast(round(sum(f.profit), 2) AS double) AS profit
    FROM (SELECT cast(strftime(order_date, '%Y%m%d') AS int) AS order_date_key, profit
          FROM sales_lines) f
    JOIN dim_date_sql d ON f.order_date_key = d.date_key GROUP BY d.year, d.quarter
""")
def join_fact_dim_rename(s: Source) -> DataFrame:
    keyed = s.lines("order_date", "profit").select(
        date_key("order_date").alias("order_date_key"), "profit"
    )
    days = calendar(s)
    joined = keyed.join(days, keyed["order_date_key"] == days["date_key"])
    return joined.groupBy("year", "quarter").agg(sales.profit())


@query("join_cross_scalar", """
    SELECT customer_id, date_diff('day', max(order_date),
        (SELECT max(order_date) FROM sales_lines)) AS days_behind
    FROM sales_lines GROUP BY customer_id
""")
def join_cross_scalar(s: Source) -> DataFrame:
    """Each customer against the one-row anchor, as a scalar subquery."""
    lines = s.lines("customer_id", "order_date")
    last = stored(lines.groupBy("customer_id").agg(F.max("order_date").alias("last")), "last-orders")
    anchor = last.agg(F.max("last")).scalar()
    return last.select("customer_id", F.datediff(anchor, "last").cast("bigint").alias("days_behind"))


@query("scalar_subquery", """
    SELECT least((SELECT min(order_date) FROM sales_lines), (SELECT min(ship_date) FROM sales_lines))
            AS first_day,
        greatest((SELECT max(order_date) FROM sales_lines), (SELECT max(ship_date) FROM sales_lines))
            AS last_day
""")
def scalar_subquery(s: Source) -> DataFrame:
    return star.calendar_bounds(s.lines(*DATES))


@query("anti_join_orphans", """
    SELECT c_custkey AS customer_id FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
""")
def anti_join_orphans(s: Source) -> DataFrame:
    """Customers without an order: keys of one table that the other lacks."""
    known = s.table("orders").select(F.col("o_custkey").alias("customer_id"))
    keys = s.table("customer").select(F.col("c_custkey").alias("customer_id"))
    return star.orphans(keys, known, "customer_id")


@query("except_distinct", """
    SELECT product_id FROM (
        SELECT p_partkey AS product_id FROM part EXCEPT SELECT l_partkey FROM lineitem)
""")
def except_distinct(s: Source) -> DataFrame:
    catalog = s.table("part").select(F.col("p_partkey").alias("product_id"))
    return catalog.subtract(s.lines("product_id"))


@query("insert_if_absent", """
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment
    FROM customer
""")
def insert_if_absent(s: Source) -> DataFrame:
    """Customers with sales first, then all customers: only new ids are added."""
    selling = star.distinct_by_key(s.lines(*CUSTOMER), *CUSTOMER)
    everyone = s.table("customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
    )
    return star.insert_if_absent(selling, everyone, "customer_id")


@query("distinct_dimension", """
    SELECT DISTINCT product_id, product_name, category, sub_category FROM sales_lines
""")
def distinct_dimension(s: Source) -> DataFrame:
    return star.distinct_by_key(s.lines(*PRODUCT), *PRODUCT)


@query("filter_not_null_key", """
    SELECT count(*) AS lines, cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines WHERE postal_code IS NOT NULL
""")
def filter_not_null_key(s: Source) -> DataFrame:
    kept = s.lines("postal_code", "sales").filter(F.col("postal_code").isNotNull())
    return kept.agg(F.count(F.lit(1)).alias("lines"), sales.revenue())


@query("having_duplicates", """
    SELECT l_orderkey AS order_id, l_linenumber AS line_number, count(*) AS copies
    FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def having_duplicates(s: Source) -> DataFrame:
    keys = s.table("lineitem").groupBy(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_number")
    )
    return keys.agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


@query("drop_columns", """
    SELECT order_id, row_id, cast(sales AS double) AS sales FROM sales_lines
""")
def drop_columns(s: Source) -> DataFrame:
    kept = s.lines("order_id", "row_id", "order_date", "ship_mode", "sales")
    return kept.drop("order_date", "ship_mode").withColumn("sales", F.col("sales").cast("double"))


@query("fn_date_key", """
    SELECT DISTINCT order_date, cast(strftime(order_date, '%Y%m%d') AS int) AS date_key
    FROM sales_lines
""")
def fn_date_key(s: Source) -> DataFrame:
    return s.lines("order_date").distinct().select(
        "order_date", date_key("order_date").alias("date_key")
    )


@query("fn_to_date", """
    SELECT cast(strftime(o_orderdate, '%Y-%m-%d') AS date) AS day, count(*) AS orders
    FROM orders GROUP BY 1
""")
def fn_to_date(s: Source) -> DataFrame:
    text = s.table("orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"))
    return text.groupBy(F.to_date("text").alias("day")).agg(F.count(F.lit(1)).alias("orders"))


@query("fn_calendar_parts", """
    SELECT DISTINCT ship_date, cast(year(ship_date) AS int) AS year,
        cast(quarter(ship_date) AS int) AS quarter, cast(month(ship_date) AS int) AS month,
        strftime(ship_date, '%b') AS month_name, cast(week(ship_date) AS int) AS week,
        cast(dayofweek(ship_date) + 1 AS int) AS day_of_week,
        strftime(ship_date, '%a') AS day_name, dayofweek(ship_date) IN (0, 6) AS is_weekend
    FROM sales_lines
""")
def fn_calendar_parts(s: Source) -> DataFrame:
    return s.lines("ship_date").distinct().withColumns(calendar_parts("ship_date"))


@query("fn_make_date", "SELECT DISTINCT make_date(year, month, 1) AS month_start FROM months")
def fn_make_date(s: Source) -> DataFrame:
    parts = s.lines("order_date").select(
        F.year("order_date").alias("y"), F.month("order_date").alias("m")
    ).distinct()
    return parts.select(F.make_date("y", "m", F.lit(1)).alias("month_start"))


@query("fn_add_months", """
    SELECT DISTINCT cast(date_trunc('month', order_date) AS date) AS month_start,
        cast(date_trunc('month', order_date) + INTERVAL 6 MONTH AS date) AS half_year_on
    FROM sales_lines
""")
def fn_add_months(s: Source) -> DataFrame:
    months = s.lines("order_date").select(F.trunc("order_date", "month").alias("month_start"))
    return months.distinct().withColumn("half_year_on", F.add_months("month_start", 6))


@query("fn_datediff", """
    SELECT date_diff('day', order_date, ship_date) AS days_to_ship, count(*) AS lines
    FROM sales_lines GROUP BY 1
""")
def fn_datediff(s: Source) -> DataFrame:
    days = F.datediff("ship_date", "order_date").cast("bigint").alias("days_to_ship")
    return s.lines(*DATES).groupBy(days).agg(F.count(F.lit(1)).alias("lines"))


@query("fn_least_greatest", """
    SELECT year(order_date)::int AS year, min(least(order_date, ship_date)) AS first_touch,
        max(greatest(order_date, ship_date)) AS last_touch
    FROM sales_lines GROUP BY 1
""")
def fn_least_greatest(s: Source) -> DataFrame:
    return s.lines(*DATES).groupBy(F.year("order_date").alias("year")).agg(
        F.min(F.least(*DATES)).alias("first_touch"),
        F.max(F.greatest(*DATES)).alias("last_touch"),
    )
