"""Publishing finished tables to a serving database or to files."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tallymill.sources.tables import read_table, row_counts, write_table

# table -> the columns its served copy is sorted by
CATALOG = {
    "monthly_revenue": ("year", "month"),
    "revenue_by_category": ("revenue",),
    "revenue_by_region": ("revenue",),
    "top_products": ("revenue",),
    "customer_rfm": ("monetary",),
    "customer_segments": ("monetary",),
    "sales_forecast": ("forecast_month", "model_name"),
}
Sink = Callable[[DataFrame, str], None]


def sort_for_publish(df: DataFrame, sort_by: Sequence[str]) -> DataFrame:
    """Sort by those of the columns that exist."""
    present = [c for c in sort_by if c in df.columns]
    return df.orderBy(*present) if present else df


def jdbc_options(url: str, table: str, **options: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, **options}


def publish_jdbc(
    df: DataFrame, url: str, table: str, sort_by: Sequence[str] = (), **options: str
) -> None:
    """Overwrite a database table but keep its definition and indexes."""
    target = jdbc_options(url, table, truncate="true", **options)
    sort_for_publish(df, sort_by).write.format("jdbc").options(**target).mode("overwrite").save()


def append_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("append").save()


def readback_jdbc(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def jdbc_sink(url: str, schema: str, **options: str) -> Sink:
    def put(df: DataFrame, table: str) -> None:
        publish_jdbc(df, url, f"{schema}.{table}", CATALOG.get(table, ()), **options)

    return put


def file_sink(root: str, format: str = "parquet") -> Sink:
    def put(df: DataFrame, table: str) -> None:
        sorted_rows = sort_for_publish(df, CATALOG.get(table, ()))
        write_table(sorted_rows, f"{root}/{table}", format=format)

    return put


def publish_catalog(tables: Mapping[str, DataFrame], sink: Sink) -> list[str]:
    """Publish every catalog table that is given; returns the names published."""
    names = [name for name in CATALOG if name in tables]
    for name in names:
        sink(tables[name], name)
    return names


def published_counts(spark: SparkSession, root: str, names: Sequence[str]) -> DataFrame:
    """(table_name, rows) of the files published under ``root``."""
    return row_counts({n: read_table(spark, f"{root}/{n}") for n in names})
