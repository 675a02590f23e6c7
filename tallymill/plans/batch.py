"""The whole batch path: raw lines to star schema, aggregates, marts, forecasts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.operators import customers, forecasting, marts, quality, sales, star
from tallymill.session import FREE_SHUFFLES, settings, stored
from tallymill.sources import serving
from tallymill.sources.publish import CATALOG
from tallymill.sources.tables import ingest_bronze, read_table, write_table

PUBLISHED = (
    *CATALOG, "mart_executive_kpis", "mart_customer_intelligence", "mart_forecast_performance",
)


def build_star(spark: SparkSession, bronze: DataFrame, root: str) -> dict[str, DataFrame]:
    """Write the dimensions and the fact under ``root`` and return the tables."""
    tables: dict[str, DataFrame] = {}

    def save(name: str, df: DataFrame, *partition_by: str) -> None:
        write_table(df, f"{root}/{name}", partition_by, large=bool(partition_by))
        tables[name] = read_table(spark, f"{root}/{name}")

    save("dim_customer", star.dim_customer(bronze))
    save("dim_product", star.dim_product(bronze))
    save("dim_region", star.dim_region(bronze))
    save("dim_ship_mode", star.dim_ship_mode(bronze))
    save("dim_date", star.dim_date(bronze))
    fact = star.fact_sales(
        bronze, tables["dim_customer"], tables["dim_product"], tables["dim_region"],
        tables["dim_ship_mode"],
    )
    save("fact_sales", fact, "order_year")
    return tables


def gold_plans(tables: Mapping[str, DataFrame], top_n: int = 100) -> dict[str, DataFrame]:
    """The served aggregates, planned over the star schema.

    Of the fact, only what a table needs is shuffled: products meet the
    dimension as totals, written once for both their tables, and months count
    their orders apart from the sums.
    """
    fact, days = tables["fact_sales"], tables["dim_date"]
    sold = stored(star.product_totals(fact), "product-totals")
    by_product = star.star_lines(sold, products=tables["dim_product"])
    by_customer = star.star_lines(fact, calendar=days, customers=tables["dim_customer"])
    return {
        "monthly_revenue": sales.monthly_revenue(star.star_lines(fact, calendar=days), apart=True),
        "revenue_by_category": sales.revenue_by_category(by_product),
        "revenue_by_region": sales.revenue_by_region(
            star.star_lines(fact, regions=tables["dim_region"])
        ),
        "top_products": sales.top_products(by_product, top_n),
        "customer_rfm": customers.customer_rfm(by_customer),
    }


def mart_plans(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "mart_executive_kpis": marts.executive_kpis(gold["monthly_revenue"]),
        "mart_customer_intelligence": customers.customer_intelligence(gold["customer_rfm"]),
    }


def build_warehouse(
    spark: SparkSession, raw: DataFrame, root: str, top_n: int = 100
) -> dict[str, DataFrame]:
    """Raw files to bronze, star schema, aggregates and marts, each one written."""
    bronze = ingest_bronze(spark, raw, f"{root}/bronze")
    tables = build_star(spark, bronze, f"{root}/silver")
    for plans in (lambda: gold_plans(tables, top_n), lambda: mart_plans(tables)):
        for name, df in plans().items():
            write_table(df, f"{root}/gold/{name}")
            tables[name] = read_table(spark, f"{root}/gold/{name}")
    return {"bronze": bronze, **tables}


def build_models(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    models: Mapping[str, forecasting.Model] = forecasting.MODELS,
) -> dict[str, DataFrame]:
    """Clusters of the customers, forecasts of every category, and their mart, from built tables."""
    path = f"{root}/gold/customer_segments"
    write_table(customers.clustered_segments(tables["customer_rfm"]), path)
    by_product = star.star_lines(
        tables["fact_sales"], calendar=tables["dim_date"], products=tables["dim_product"]
    )
    forecasts = build_forecasts(spark, by_product, f"{root}/gold", F.col("category"), models)
    return {"customer_segments": read_table(spark, path), **forecasts}


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    computed_at: dt.datetime,
    top_n: int = 100,
    models: Mapping[str, forecasting.Model] = forecasting.MODELS,
) -> dict[str, DataFrame]:
    """The whole run: warehouse, models, checks, then a new served version of the gold tables.

    A failed check stops the run before anything is switched, so readers keep
    the version before. Returns the built tables; the published ones as served.
    """
    built = build_warehouse(spark, raw, root, top_n)
    with settings(spark, FREE_SHUFFLES):
        failed = verify_warehouse(built).filter("NOT passed").select("check_name", "table_name").collect()
    if failed:
        raise RuntimeError(f"not published: {[tuple(r) for r in failed]}")
    built |= build_models(spark, built, root, models)
    serving.publish_version({name: built[name] for name in PUBLISHED}, f"{root}/serving", computed_at)
    return built | serving.served_tables(spark, f"{root}/serving")


def verify_warehouse(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Parity, uniqueness and key checks over a built warehouse."""
    bronze, fact = tables["bronze"], tables["fact_sales"]
    monthly = tables["monthly_revenue"].withColumnRenamed("revenue", "sales")
    return quality.report(
        quality.row_count_parity(bronze, fact, "fact_sales"),
        quality.measure_parity(bronze, fact, "fact_sales", "sales"),
        quality.measure_parity(bronze, fact, "fact_sales", "profit"),
        quality.measure_parity(fact, monthly, "monthly_revenue", "sales", 5.0),
        quality.unique(fact, "fact_sales", "order_id", "row_id"),
        quality.unique(tables["dim_customer"], "dim_customer", "customer_id"),
        quality.unique(tables["dim_product"], "dim_product", "product_id"),
        quality.referential_integrity(
            fact, "customer_key", tables["dim_customer"], "fact_sales"),
        quality.referential_integrity(fact, "product_key", tables["dim_product"], "fact_sales"),
        quality.calendar_continuous(tables["dim_date"], "dim_date"),
        quality.check_rows(
            fact, "fact_sales",
            *quality.not_null(
                "customer_key", "product_key", "region_key", "ship_mode_key", "order_date_key",
                *star.MEASURES,
            ),
        ),
    )


def build_forecasts(
    spark: SparkSession,
    lines: DataFrame,
    root: str,
    series: Column | None = None,
    models: Mapping[str, forecasting.Model] = forecasting.MODELS,
) -> dict[str, DataFrame]:
    """Forecast every series and write the forecast and its mart."""
    monthly = forecasting.monthly_series(lines, series)
    write_table(forecasting.sales_forecast(monthly, models), f"{root}/sales_forecast")
    forecast = read_table(spark, f"{root}/sales_forecast")
    write_table(
        marts.forecast_performance(forecast, "series_id"), f"{root}/mart_forecast_performance"
    )
    mart = read_table(spark, f"{root}/mart_forecast_performance")
    return {"sales_forecast": forecast, "mart_forecast_performance": mart}
