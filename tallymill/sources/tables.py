"""Files in and out: scans, header clean-up, ingestion and table writes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.functions.expressions import typed
from tallymill.functions.unions import union_rows
from tallymill.session import DENSE, FREE_SHUFFLES, settings

# Localised headers and the names they stand for.
HEADER_NAMES = {
    "linha_id": "row_id",
    "ordem_id": "order_id",
    "data_ordem": "order_date",
    "data_envio": "ship_date",
    "modo_envio": "ship_mode",
    "cliente_id": "customer_id",
    "nome_cliente": "customer_name",
    "segmento": "segment",
    "pais": "country",
    "país": "country",
    "cidade": "city",
    "estado": "state",
    "codigo_postal": "postal_code",
    "regiao": "region",
    "região": "region",
    "produto_id": "product_id",
    "categoria": "category",
    "sub_categoria": "sub_category",
    "nome_produto": "product_name",
    "vendas": "sales",
    "quantidade": "quantity",
    "desconto": "discount",
    "lucro": "profit",
}

# The raw order-line columns and the types the typed view gives them.
LINE_TYPES = {
    "row_id": "bigint",
    "order_id": "string",
    "order_date": "date",
    "ship_date": "date",
    "ship_mode": "string",
    "customer_id": "string",
    "customer_name": "string",
    "segment": "string",
    "country": "string",
    "city": "string",
    "state": "string",
    "postal_code": "string",
    "region": "string",
    "product_id": "string",
    "category": "string",
    "sub_category": "string",
    "product_name": "string",
    "sales": "decimal(12,4)",
    "quantity": "bigint",
    "discount": "decimal(5,4)",
    "profit": "decimal(12,4)",
}


# files that one task holds open in a partitioned write; rows of further values are sorted
OPEN_FILES = 32


def text_schema(columns: Sequence[str] = tuple(LINE_TYPES)) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def scan_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Several files or globs as one table with the union of their columns."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A UTF-8 CSV with a header, read with a declared schema."""
    return (
        spark.read.schema(schema)
        .options(header="true", encoding="UTF-8", enforceSchema="true").csv(path)
    )


def clean_header(name: str) -> str:
    plain = name.strip().lower().replace(" ", "_").replace("-", "_")
    return HEADER_NAMES.get(plain, plain)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Headers to English snake_case."""
    return df.toDF(*(clean_header(c) for c in df.columns))


def validate_columns(
    df: DataFrame, expected: Sequence[str] = tuple(LINE_TYPES), least_rows: int = 100
) -> DataFrame:
    """One row: the expected columns that are missing, the rows, both verdicts."""
    missing = sorted(set(expected) - set(df.columns))
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(",".join(missing)).alias("missing_columns"),
        F.lit(not missing).alias("columns_ok"),
        "rows",
        (F.col("rows") >= least_rows).alias("rows_ok"),
    )


def stage_typed(df: DataFrame, types: Mapping[str, str] = LINE_TYPES) -> DataFrame:
    """Raw text columns as typed ones; blanks and unreadable values become NULL."""
    return df.select(*(typed(c, kind).alias(c) for c, kind in types.items() if c in df.columns))


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN to NULL in every floating-point column."""
    return df.replace(float("nan"), None)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    format: str = "parquet",
    large: bool = False,
) -> None:
    """Write a table, optionally in one folder per value of some columns.

    Rows are rebalanced on those columns first: few files per folder, and a
    value with very many rows is still split over several tasks. A ``large``
    table, whose rows come in large tasks as they are, is not shuffled for that:
    a task writes a file for each of its values, up to ``OPEN_FILES`` side by
    side, without sorting its rows.
    """
    conf = dict(FREE_SHUFFLES)
    if large:
        conf["spark.sql.maxConcurrentOutputFileWriters"] = str(OPEN_FILES)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    options = DENSE if large and format == "parquet" else {}
    with settings(df.sparkSession, conf):
        df.write.format(format).options(**options).mode(mode).partitionBy(*partition_by).save(path)


def read_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    return spark.read.format(format).load(path)


def ingest_bronze(
    spark: SparkSession,
    raw: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("category",),
    mode: str = "overwrite",
    format: str = "parquet",
) -> DataFrame:
    """Store raw rows with their lineage and return the stored table.

    ``raw`` is a file scan, so each row knows its file, and its tasks are large
    enough to write from, without a shuffle of whole rows. The rows are counted
    by the write itself and must all be in the table afterwards.
    """
    seen, now = Observation(), F.lit(dt.datetime.now(dt.timezone.utc))
    lineage = raw.withColumns({
        "_ingested_at": now,
        "_source_file": F.col("_metadata.file_path"),
        "_layer": F.lit("bronze"),
    }).observe(seen, F.count(F.lit(1)).alias("rows"))
    write_table(lineage, path, partition_by, mode, format, large=True)
    table = read_table(spark, path, format)
    ours = table.filter(F.col("_ingested_at") == now).agg(F.count(F.lit(1))).first()[0]
    if ours != seen.get["rows"]:
        raise RuntimeError(f"{path}: {seen.get['rows']} rows read, {ours} stored")
    return table


def read_sql(spark: SparkSession, query: str, args: Mapping | None = None, **tables) -> DataFrame:
    """SQL text over named frames (``{name}``) with named parameters (``:name``)."""
    return spark.sql(query, args=dict(args or {}), **tables)


def row_counts(named: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of several tables."""
    return union_rows(
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in named.items()
    )


def materialize_view(df: DataFrame, path: str) -> DataFrame:
    """Replace the stored copy of a view and read it back."""
    write_table(df, path)
    return read_table(df.sparkSession, path)
