"""Queries that read, clean, write and read back tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.operators import customers, sales, star
from tallymill.plans import customer_queries, forecast_queries, sales_queries
from tallymill.plans.batch import build_warehouse, run_batch, verify_warehouse
from tallymill.plans.registry import Source, query, with_lines
from tallymill.session import DENSE, stored
from tallymill.sources import publish, serving, tables

# an order line with localised, untidy headers
HEADERS = {
    "row_id": "Linha ID", "order_id": " Ordem-ID ", "order_date": "Data Ordem",
    "ship_date": "data-envio", "ship_mode": "Modo Envio", "customer_id": "Cliente ID",
    "customer_name": "Nome Cliente", "segment": "Segmento", "country": "País", "city": "Cidade",
    "state": "ESTADO", "postal_code": "Codigo Postal", "region": "Região",
    "product_id": "Produto-ID", "category": "Categoria", "sub_category": "Sub-Categoria",
    "product_name": "Nome Produto", "sales": "Vendas", "quantity": "QUANTIDADE",
    "discount": "Desconto", "profit": "lucro ",
}
# the same without accents, as the CSV has them
ASCII_HEADERS = {**HEADERS, "country": "Pais", "region": "Regiao"}
AMOUNTS = ("sales", "discount", "profit")
IDS = ("order_id", "customer_id", "product_id")


def lines_sql(*as_text: str) -> str:
    """All columns of the order lines, amounts as doubles and the named ones as text."""
    kinds = {**dict.fromkeys(AMOUNTS, "double"), **dict.fromkeys(as_text, "varchar")}
    columns = (f"cast({c} AS {kinds[c]}) AS {c}" if c in kinds else c for c in tables.LINE_TYPES)
    return f"SELECT {', '.join(columns)} FROM sales_lines"


@query("scan_parquet_glob", """
    SELECT count(*) AS rows, count(o_orderkey) AS orders, count(c_custkey) AS customers
    FROM (SELECT o_orderkey, cast(NULL AS bigint) AS c_custkey FROM orders
          UNION ALL SELECT NULL, c_custkey FROM customer)
""")
def scan_parquet_glob(s: Source) -> DataFrame:
    """Two files with different columns as one table."""
    files = (f"{s.folder}/orders.parquet", f"{s.folder}/customer.parquet")
    both = tables.scan_parquet(s.spark, *files)
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count("o_orderkey").alias("orders"),
        F.count("c_custkey").alias("customers"),
    )


def _csv_copy(s: Source) -> DataFrame:
    """All order lines, as text, in a CSV with the localised headers."""
    path = s.scratch("csv")
    text = s.lines(*ASCII_HEADERS).select(*(
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(h) for c, h in ASCII_HEADERS.items()
    ))
    text.write.option("header", "true").csv(path)
    return tables.scan_csv(s.spark, path, tables.text_schema(list(ASCII_HEADERS.values())))


@query("scan_csv_typed", lines_sql(*IDS))
def scan_csv_typed(s: Source) -> DataFrame:
    typed = tables.stage_typed(tables.normalize_columns(_csv_copy(s)))
    return sales_queries.doubles(typed, *AMOUNTS)


@query("normalize_columns", lines_sql())
def normalize_columns(s: Source) -> DataFrame:
    untidy = s.lines(*HEADERS).withColumnsRenamed(HEADERS)
    return sales_queries.doubles(tables.normalize_columns(untidy), *AMOUNTS)


@query("validate_columns", """
    SELECT 'profit' AS missing_columns, false AS columns_ok, count(*) AS rows,
        count(*) >= 100 AS rows_ok FROM sales_lines
""")
def validate_columns(s: Source) -> DataFrame:
    columns = [c for c in tables.LINE_TYPES if c not in ("profit", "row_id")]
    return tables.validate_columns(s.lines(*columns), [*columns, "profit"])


@query("stage_typed", lines_sql(*IDS))
def stage_typed(s: Source) -> DataFrame:
    """Untyped text lines, with blanks for missing values, as typed columns."""
    text = s.lines(*tables.LINE_TYPES).select(*(
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in tables.LINE_TYPES
    ))
    return sales_queries.doubles(tables.stage_typed(text), *AMOUNTS)


def _raw_files(s: Source) -> DataFrame:
    return stored(s.lines(), "raw", **DENSE)


@query("ingest_bronze", """
    SELECT category, 'bronze' AS layer, true AS has_file, count(*) AS lines,
        cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines GROUP BY category
""")
def ingest_bronze(s: Source) -> DataFrame:
    bronze = tables.ingest_bronze(s.spark, _raw_files(s), s.scratch("bronze"))
    return bronze.groupBy("category", F.col("_layer").alias("layer")).agg(
        F.bool_and(F.col("_source_file").endswith(".parquet")).alias("has_file"),
        F.count(F.lit(1)).alias("lines"), sales.revenue(),
    )


@query("write_mode", """
    SELECT segment, 2 * count(*) AS customers FROM customer JOIN (
        SELECT c_custkey, c_mktsegment AS segment FROM customer) USING (c_custkey) GROUP BY segment
""")
def write_mode(s: Source) -> DataFrame:
    """Overwrite twice, then append once: two copies of every row."""
    rows, path = s.table("customer").withColumnRenamed("c_mktsegment", "segment"), s.scratch("mode")
    for mode in ("overwrite", "overwrite", "append"):
        tables.write_table(rows, path, mode=mode)
    return tables.read_table(s.spark, path).groupBy("segment").agg(
        F.count(F.lit(1)).alias("customers")
    )


@query("write_table", """
    SELECT year(o_orderdate)::int AS order_year, count(*) AS orders,
        count(DISTINCT o_custkey) AS customers FROM orders GROUP BY 1
""")
def write_table(s: Source) -> DataFrame:
    rows = s.table("orders").withColumn("order_year", F.year("o_orderdate"))
    path = s.scratch("orders")
    tables.write_table(rows, path, ["order_year"])
    return tables.read_table(s.spark, path).groupBy("order_year").agg(
        F.count(F.lit(1)).alias("orders"), F.count_distinct("o_custkey").alias("customers")
    )


query("read_table", "SELECT * FROM supplier")(
    lambda s: tables.read_table(s.spark, f"{s.folder}/supplier.parquet"))

query("materialize_view", "SELECT * FROM months")(
    lambda s: tables.materialize_view(sales_queries.monthly(s), s.scratch("mv_monthly_revenue")))


@query("read_sql", """
    SELECT region, count(*) AS lines, cast(round(sum(sales), 2) AS double) AS revenue
    FROM sales_lines WHERE sales >= 50000 GROUP BY region
""")
def read_sql(s: Source) -> DataFrame:
    return tables.read_sql(
        s.spark,
        "SELECT region, count(*) AS lines, cast(round(sum(sales), 2) AS double) AS revenue"
        " FROM {lines} WHERE sales >= :least GROUP BY region",
        {"least": 50_000},
        lines=s.lines("region", "sales"),
    )


# what each digest is taken over; the cluster of a customer is the model's choice
CONTENTS = {
    "monthly_revenue": "year month month_name revenue profit orders avg_line_value",
    "revenue_by_category": "category sub_category revenue profit units",
    "revenue_by_region": "region state revenue profit",
    "top_products": "product_id product_name category revenue profit units",
    "customer_rfm": "customer_id customer_name segment recency_days frequency monetary"
                    " r_score f_score m_score rfm_score cluster_label",
    "customer_segments": "customer_id customer_name segment recency_days frequency monetary"
                         " r_score f_score m_score rfm_score cluster_label",
    "sales_forecast": "series_id forecast_month model_name yhat yhat_lower yhat_upper is_winner",
    "mart_executive_kpis": "year year_revenue year_profit profit_margin_pct revenue_to_profit"
                           " months_reported prev_year_revenue yoy_growth_pct",
    "mart_customer_intelligence": "cluster_label customers avg_recency_days avg_frequency avg_monetary"
                                  " total_monetary pct_of_customers pct_of_revenue",
    "mart_forecast_performance": "series_id forecast_month winning_model forecast_revenue yhat_lower"
                                 " yhat_upper lower_uncertainty upper_uncertainty",
    "bronze": " ".join(tables.LINE_TYPES),
    "dim_customer": "customer_key customer_id customer_name segment",
    "dim_product": "product_key product_id product_name category sub_category",
    "dim_region": "region_key country region state city postal_code",
    "dim_ship_mode": "ship_mode_key ship_mode",
    "dim_date": "date_key full_date year quarter month month_name week day_of_week day_name is_weekend",
    "fact_sales": "order_id row_id customer_key product_key region_key ship_mode_key order_date_key"
                  " ship_date_key sales quantity discount profit order_year",
}
COLUMNS = {name: columns.split() for name, columns in CONTENTS.items()}
# the SQL of each table, as the query of the table itself has it
TABLE_SQL = {
    **{name: f"SELECT * FROM {name}_sql" for name in (
        "dim_customer", "dim_product", "dim_region", "dim_ship_mode", "dim_date")},
    "bronze": "SELECT * FROM sales_lines", "fact_sales": "SELECT * FROM fact_sql",
    "monthly_revenue": "SELECT * FROM months", "revenue_by_category": "SELECT * FROM categories",
    "revenue_by_region": "SELECT * FROM places", "top_products": sales_queries.TOP.format(100),
    "customer_rfm": "SELECT * FROM segments", "customer_segments": "SELECT * FROM segments",
    "sales_forecast": "SELECT * FROM forecast_sql",
    "mart_executive_kpis": sales_queries.EXECUTIVE_SQL,
    "mart_customer_intelligence": customer_queries.INTELLIGENCE_SQL,
    "mart_forecast_performance": forecast_queries.PERFORMANCE_SQL,
}


def contents_sql(*names: str) -> str:
    return " UNION ALL ".join(serving.contents_sql(n, TABLE_SQL[n], COLUMNS[n]) for n in names)


@query("publish_catalog", contents_sql(*publish.CATALOG))
def publish_catalog(s: Source) -> DataFrame:
    # only tables of the same joins share lines: others keep or repeat other lines where keys are odd
    bought = with_lines(s, *customers.CUSTOMER, "order_id", "order_date", "sales")
    sold = with_lines(
        s, "product_id", "product_name", "category", "sub_category", "sales", "profit", "quantity"
    )
    root = s.scratch("published")
    names = publish.publish_catalog(
        {
            "monthly_revenue": sales_queries.monthly(s),
            "revenue_by_category": sales_queries.categories(sold),
            "revenue_by_region": sales_queries.places(s),
            "top_products": sales.top_products(sales_queries.product_lines(sold)),
            "customer_rfm": customer_queries.rfm(bought),
            "customer_segments": customers.customer_segments(customer_queries.lines(bought)),
            "sales_forecast": forecast_queries.forecast(s),
        },
        publish.file_sink(root),
    )
    return serving.contents_of({n: tables.read_table(s.spark, f"{root}/{n}") for n in names}, COLUMNS)


@query("sort_for_publish", "SELECT * FROM segments ORDER BY monetary, customer_id")
def sort_for_publish(s: Source) -> DataFrame:
    return publish.sort_for_publish(
        customer_queries.rfm(s), [*publish.CATALOG["customer_rfm"], "customer_id", "absent"]
    )


@query("nan_to_null", """
    SELECT order_id, row_id, CASE WHEN discount = 0 THEN NULL
        ELSE cast(profit AS double) / cast(discount AS double) END AS profit_per_discount
    FROM sales_lines
""")
def nan_to_null(s: Source) -> DataFrame:
    """A ratio that is NaN where its divisor is zero, cleaned to NULL."""
    lines = s.lines("order_id", "row_id", "discount", "profit")
    ratio = F.when(F.col("discount") == 0, F.lit(float("nan"))).otherwise(
        F.try_divide(F.col("profit").cast("double"), F.col("discount").cast("double"))
    )
    return tables.missing_to_null(
        lines.select("order_id", "row_id", ratio.alias("profit_per_discount"))
    )


@query("load_dataframe", "SELECT * FROM part")
def load_dataframe(s: Source) -> DataFrame:
    path = s.scratch("load")
    tables.write_table(s.table("part"), path)
    return tables.read_table(s.spark, path)


#: When the registered run says that its tables were computed.
COMPUTED_AT = dt.datetime(2024, 1, 31, 23, 30)


@query("batch_build", contents_sql(*COLUMNS))
def batch_build(s: Source) -> DataFrame:
    """The whole run, models and publishing too; per table, its rows and a digest of them.

    The gold tables are read as served. The models are those that SQL can fit again.
    """
    built = run_batch(
        s.spark, _raw_files(s), s.scratch("warehouse"), COMPUTED_AT, models=forecast_queries.CHECKED
    )
    return serving.contents_of({n: built[n] for n in COLUMNS}, COLUMNS)


@query("batch_verify", """
    SELECT check_name, table_name, cast(0 AS bigint) AS failures, true AS passed FROM (VALUES
        ('row_count_parity', 'fact_sales'), ('measure_parity', 'fact_sales'),
        ('measure_parity', 'monthly_revenue'), ('unique', 'fact_sales'),
        ('unique', 'dim_customer'), ('unique', 'dim_product'),
        ('referential_integrity', 'fact_sales'), ('calendar_continuous', 'dim_date'),
        ('not_null', 'fact_sales')) AS t(check_name, table_name)
""")
def batch_verify(s: Source) -> DataFrame:
    """Build everything, then the built tables' own checks, worst result per kind."""
    built = build_warehouse(s.spark, _raw_files(s), s.scratch("warehouse"))
    return verify_warehouse(built).groupBy("check_name", "table_name").agg(
        F.sum("failures").alias("failures"), F.bool_and("passed").alias("passed")
    )
