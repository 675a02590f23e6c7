"""Flat order lines over the source tables.

``order_lines`` joins only the tables that supply the requested columns. The
order header (order, customer, nation, region) is put together first, so the
much larger line table is shuffled once, on the order key. Where it is shuffled
on the part key as well, the names of nations and regions come after that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# column -> (table that supplies it, expression)
COLUMNS = {
    "row_id": ("numbering", "row_id"),
    "order_id": ("lineitem", "l_orderkey"),
    "order_date": ("orders", "cast(o_orderdate AS date)"),
    "ship_date": ("lineitem", "cast(l_shipdate AS date)"),
    "ship_mode": ("orders", "o_orderpriority"),
    "customer_id": ("orders", "o_custkey"),
    "customer_name": ("customer", "c_name"),
    "segment": ("customer", "c_mktsegment"),
    "country": ("region", "r_name"),
    "city": ("orders", "concat('CITY_', cast(o_custkey % 100 AS string))"),
    "state": ("nation", "n_name"),
    "postal_code": (
        "nation",
        "CASE WHEN n_nationkey % 5 <> 0 THEN cast(10000 + n_nationkey AS string) END",
    ),
    "region": ("region", "r_name"),
    "product_id": ("lineitem", "l_partkey"),
    "category": ("part", "p_type"),
    "sub_category": ("part", "p_brand"),
    "product_name": ("part", "p_name"),
    "sales": ("lineitem", "cast(l_extendedprice AS decimal(12,4))"),
    "quantity": ("lineitem", "cast(l_quantity AS bigint)"),
    "discount": ("lineitem", "cast(l_discount AS decimal(5,4))"),
    "profit": (
        "part",
        # narrow enough that every step fits in 18 digits, a plain long in Spark
        "cast(cast(l_extendedprice AS decimal(10,2)) * (1 - cast(l_discount AS decimal(3,2)))"
        " - cast(p_retailprice AS decimal(8,2)) * cast(l_quantity AS decimal(4,0))"
        " AS decimal(12,4))",
    ),
}

LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
NUMBERING_SALTS = 4096


def source_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _number_lines(lines: DataFrame) -> DataFrame:
    """Give the lines of an order numbers that tell them apart.

    An order may hold a large part of all lines, so it is never sorted as one
    group: its lines are split over salts and numbered inside each salt, and
    the salt leads the number. Many salts cost an ordinary order nothing, as
    it has no more of them than lines.
    """
    salted = lines.withColumn(
        "_salt", F.expr(f"(l_partkey + l_suppkey + l_linenumber) % {NUMBERING_SALTS}")
    )
    inside = Window.partitionBy("l_orderkey", "_salt").orderBy(*LINE_ORDER)
    number = F.col("_salt") * F.lit(1 << 32) + F.row_number().over(inside)
    return salted.withColumn("row_id", number)


def _listed(table: DataFrame, key: str, *columns: str) -> DataFrame:
    """One row per key, with the columns of its rows in a fixed order; a key that repeats has several."""
    return table.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(f"_{key}"))


def _join_place(header: DataFrame, key: str, listed: DataFrame, to: str, *columns: str) -> DataFrame:
    """The join with the listed table of key ``to``; of its rows, only their places in the lists and ``columns``."""
    each = listed.select(to, F.posexplode(f"_{to}").alias(f"_at_{to}", "_row"))
    each = each.select(to, f"_at_{to}", *(f"_row.{c}" for c in columns))
    return header.join(each, F.col(key) == F.col(to))


def _put_on(lines: DataFrame, key: str, listed: DataFrame, to: str) -> DataFrame:
    """The columns of the listed row whose place ``_join_place`` found."""
    found = lines.join(listed.withColumnRenamed(to, "_key"), F.col(key) == F.col("_key"))
    return found.withColumn("_row", F.col(f"_{to}")[F.col(f"_at_{to}")]).select(*lines.columns, "_row.*")


def order_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Order lines with the given columns, all of them by default.

    Every line refers to an existing order and part, every order to an
    existing customer, so leaving out an unused table keeps all lines.
    """
    columns = columns or tuple(COLUMNS)
    needed = {COLUMNS[c][0] for c in columns}
    lines = source_table(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    places = needed & {"nation", "region"} if "part" in needed else set()
    if needed & {"orders", "customer", "nation", "region"}:
        header = source_table(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
        if needed & {"customer", "nation", "region"}:
            customer = source_table(spark, folder, "customer")
            header = header.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        if needed & {"nation", "region"}:
            nation = source_table(spark, folder, "nation")
            if places:  # the rows of the join, but the names themselves are put on last
                nations = _listed(nation, "n_nationkey", "n_name", "n_regionkey")
                header = _join_place(header, "c_nationkey", nations, "n_nationkey", "n_regionkey")
            else:
                header = header.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        if "region" in needed:
            region = source_table(spark, folder, "region")
            if places:
                regions = _listed(region, "r_regionkey", "r_name")
                header = _join_place(header, "n_regionkey", regions, "r_regionkey")
            else:
                header = header.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        lines = lines.join(header, F.col("l_orderkey") == F.col("o_orderkey"))
    if "numbering" in needed:  # after the join by order, so it finds the lines dealt by order already
        lines = _number_lines(lines)
    if "part" in needed:
        part = source_table(spark, folder, "part")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if places:
        lines = _put_on(lines.drop("n_regionkey"), "n_nationkey", nations, "n_nationkey")
    if "region" in places:
        lines = _put_on(lines, "n_regionkey", regions, "r_regionkey")
    return lines.select(*(F.expr(COLUMNS[c][1]).alias(c) for c in columns))
