"""Typed staging projections over the published tables, and the marts on them."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.expressions import cents, missing_as_null, percent, ratio
from tallymill.functions.unions import union_rows
from tallymill.operators.kpis import with_yearly_growth

MONEY = "decimal(18,2)"
# column types of the staging projections; string columns pass through
STAGING = {
    "monthly_revenue": {
        "year": "int", "month": "int", "month_name": "string",
        "revenue": MONEY, "profit": MONEY, "orders": "bigint", "avg_line_value": MONEY,
    },
    "revenue_by_category": {
        "category": "string", "sub_category": "string",
        "revenue": MONEY, "profit": MONEY, "units": "bigint",
    },
    "revenue_by_region": {
        "region": "string", "state": "string", "revenue": MONEY, "profit": MONEY,
    },
    "top_products": {
        "product_id": "string", "product_name": "string", "category": "string",
        "revenue": MONEY, "profit": MONEY, "units": "bigint",
    },
    "customer_segments": {
        "customer_id": "string", "customer_name": "string", "segment": "string",
        "recency_days": "int", "frequency": "bigint", "monetary": MONEY,
        "r_score": "int", "f_score": "int", "m_score": "int",
        "rfm_score": "string", "cluster_id": "int", "cluster_label": "string",
    },
    "sales_forecast": {
        "forecast_month": "date", "model_name": "string", "yhat": MONEY,
        "yhat_lower": "double", "yhat_upper": "double", "is_winner": "boolean",
    },
}


def stage(df: DataFrame, table: str) -> DataFrame:
    """The staging projection of a published table.

    Forecast bounds stay floating point here because they may be NaN.
    """
    return df.select(*(F.col(c).cast(kind).alias(c) for c, kind in STAGING[table].items()))


def executive_kpis(monthly: DataFrame) -> DataFrame:
    """Yearly totals, margin, months reported and growth on the year before."""
    staged = stage(monthly, "monthly_revenue")
    revenue, profit = F.sum("revenue"), F.sum("profit")
    yearly = staged.groupBy("year").agg(
        cents(revenue).alias("year_revenue"),
        cents(profit).alias("year_profit"),
        percent(profit, revenue).alias("profit_margin_pct"),
        F.round(ratio(revenue, profit), 6).alias("revenue_to_profit"),
        F.count(F.lit(1)).alias("months_reported"),
    )
    return with_yearly_growth(yearly)


def winner_per_month(forecast: DataFrame, *keys: str) -> DataFrame:
    """One forecast row per month: the winner, else the first model by name."""
    choice = Window.partitionBy(*keys, "forecast_month").orderBy(
        F.desc("is_winner"), "model_name"
    )
    return (
        forecast.withColumn("_choice", F.row_number().over(choice))
        .filter("_choice = 1").drop("_choice")
    )


def forecast_performance(forecast: DataFrame, *keys: str) -> DataFrame:
    """The chosen forecast per month with its uncertainty band.

    A missing bound (NULL or NaN) is 15 percent off the forecast. ``keys``
    are further columns that tell several series apart.
    """
    yhat = F.col("yhat").cast(MONEY)
    lower = F.coalesce(missing_as_null("yhat_lower").cast(MONEY), yhat * Decimal("0.85"))
    upper = F.coalesce(missing_as_null("yhat_upper").cast(MONEY), yhat * Decimal("1.15"))
    return winner_per_month(forecast, *keys).select(
        *keys,
        "forecast_month",
        F.col("model_name").alias("winning_model"),
        cents(yhat).alias("forecast_revenue"),
        cents(lower).alias("yhat_lower"),
        cents(upper).alias("yhat_upper"),
        cents(yhat - lower).alias("lower_uncertainty"),
        cents(upper - yhat).alias("upper_uncertainty"),
    )


def forecast_vs_actual(series: DataFrame, forecast: DataFrame) -> DataFrame:
    """Actual months and the winning forecast in one long table."""
    actual = series.select("series_id", "month", F.lit("actual").alias("series"), "y")
    ahead = forecast.filter("is_winner").select(
        "series_id",
        F.col("forecast_month").alias("month"),
        F.col("model_name").alias("series"),
        F.col("yhat").alias("y"),
    )
    return union_rows([actual, ahead])
