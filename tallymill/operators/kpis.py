"""Growth, customer, product and place KPIs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.expressions import cents, mean, percent, ratio
from tallymill.operators import sales
from tallymill.operators.ranges import running_total
from tallymill.session import stored


def period_before(amount: str, *period: str) -> Column:
    """The amount of the row before, in period order.

    Monthly and yearly tables hold one row per calendar period, so a single
    window over one of them stays small however many order lines there are.
    """
    return F.lag(amount).over(Window.orderBy(*period))


def growth(amount: Column, before: Column) -> Column:
    """Change against the period before, in percent."""
    return percent(amount - before, before)


def average_discount(lines: DataFrame) -> DataFrame:
    return lines.agg(mean("discount", 6).alias("avg_discount"))


def month_over_month(monthly: DataFrame) -> DataFrame:
    before = period_before("revenue", "year", "month")
    return monthly.select(
        "year", "month", "revenue",
        before.alias("prev_revenue"),
        growth(F.col("revenue"), before).alias("mom_growth_pct"),
    )


def with_yearly_growth(yearly: DataFrame) -> DataFrame:
    """Rows of (year, year_revenue, …) plus last year's revenue and the growth."""
    before = period_before("year_revenue", "year")
    return yearly.withColumns({
        "prev_year_revenue": before,
        "yoy_growth_pct": growth(F.col("year_revenue"), before),
    })


def yearly_revenue(monthly: DataFrame) -> DataFrame:
    amount = F.col("revenue").cast("decimal(18,2)")
    return monthly.groupBy("year").agg(cents(F.sum(amount)).alias("year_revenue"))


def year_over_year(monthly: DataFrame) -> DataFrame:
    return with_yearly_growth(yearly_revenue(monthly))


def seasonality_index(monthly: DataFrame) -> DataFrame:
    """Mean revenue of each calendar month over the mean of all months."""
    amount = F.col("revenue").cast("decimal(18,2)")
    average = ratio(F.sum(amount), F.count(amount))
    overall = monthly.agg(average).scalar()
    return monthly.groupBy("month").agg(
        mean(amount).alias("avg_revenue"), average.alias("_mean")
    ).select(
        "month", "avg_revenue",
        F.round(ratio(F.col("_mean"), overall), 4).alias("seasonality_index"),
    )


def profit_by_category(lines: DataFrame) -> DataFrame:
    return lines.groupBy("category", "sub_category").agg(sales.profit())


def margin_by_region(lines: DataFrame) -> DataFrame:
    margin = percent(F.sum("profit"), F.sum("sales")).alias("margin_pct")
    return lines.groupBy("region").agg(sales.revenue(), sales.profit(), margin)


def discount_sensitivity(lines: DataFrame) -> DataFrame:
    """How quantity and profit of each product move with its discount.

    Sums are taken over scaled whole numbers, so a product with one constant
    discount has a variance of exactly zero and gets NULL.
    """
    x = (F.col("discount") * 10_000).cast("decimal(12,0)")
    y = F.col("quantity").cast("decimal(12,0)")
    z = (F.col("profit") * 10_000).cast("decimal(18,0)")
    names = {"x": x, "y": y, "z": z, "xx": x * x, "yy": y * y, "xy": x * y, "xz": x * z}
    sums = lines.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(product).cast("decimal(38,0)").alias(name) for name, product in names.items()),
    )

    def spread(a: str, b: str) -> Column:
        count = F.col("n").cast("decimal(18,0)")
        return (count * F.col(a + b) - F.col(a) * F.col(b)).cast("double")

    return sums.select(
        "product_id",
        F.col("n").alias("lines"),
        F.round(
            F.try_divide(spread("x", "y"), F.sqrt(spread("x", "x")) * F.sqrt(spread("y", "y"))), 4
        ).alias("corr_quantity"),
        F.round(F.try_divide(spread("x", "y"), spread("x", "x")) * 10_000, 2)
        .alias("quantity_slope"),
        F.round(F.try_divide(spread("x", "z"), spread("x", "x")), 2).alias("profit_slope"),
    )


def customer_pareto(lines: DataFrame, share: float = 0.8) -> DataFrame:
    """Customers from the largest down, with their cumulative revenue share."""
    revenue = lines.groupBy("customer_id").agg(
        F.sum("sales").cast("decimal(28,4)").alias("amount")
    )
    ranked = running_total(revenue, "amount", "so_far", F.desc("amount"), "customer_id")
    total = ranked.agg(F.sum("amount")).scalar()
    reached = ratio(F.col("so_far"), total)
    return ranked.select(
        "customer_id",
        cents("amount").alias("revenue"),
        F.round(100.0 * reached, 4).alias("cumulative_pct"),
        (reached <= share).alias("in_core"),
    )


def repeat_purchase_rate(lines: DataFrame) -> DataFrame:
    """Share of customers with at least two orders."""
    orders = lines.groupBy("customer_id").agg(F.count_distinct("order_id").alias("orders"))
    counted = orders.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("orders") >= 2).alias("repeat_customers"),
    )
    rate = percent(F.col("repeat_customers"), F.col("customers"))
    return counted.withColumn("repeat_rate_pct", rate)


def lifetime_value(rfm_view: DataFrame) -> DataFrame:
    """Average order value times number of orders."""
    value = cents(F.col("avg_order_value").cast("decimal(18,2)") * F.col("frequency"))
    return rfm_view.select(
        "customer_id", "avg_order_value", "frequency", value.alias("clv_proxy")
    )


def _silent_days(lines: DataFrame, key: str, days: int, as_of: dt.date | None) -> DataFrame:
    last = lines.groupBy(key).agg(F.max("order_date").alias("last_order"))
    if as_of is None:
        last = stored(last, "last-orders")  # the newest date is found in it, not in a second join
        anchor = last.agg(F.max("last_order")).scalar()
    else:
        anchor = F.lit(as_of)
    return last.withColumn("days_since", F.datediff(anchor, "last_order")).withColumn(
        "silent", F.col("days_since") > days
    )


def churn_flags(lines: DataFrame, days: int = 180, as_of: dt.date | None = None) -> DataFrame:
    """Customers with no order in the last ``days`` days are churned."""
    return _silent_days(lines, "customer_id", days, as_of).withColumnRenamed("silent", "churned")


def dead_stock(lines: DataFrame, days: int = 90, as_of: dt.date | None = None) -> DataFrame:
    """Products without a sale in the last ``days`` days."""
    return _silent_days(lines, "product_id", days, as_of).filter("silent").drop("silent")
