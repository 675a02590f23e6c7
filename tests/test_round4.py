"""What round 4 found: the batch run keeps to few bytes on disk, with the same tables."""

import contextlib
import datetime as dt
import glob
import io
import time
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymill.operators import customers, sales, star
from tallymill.plans import batch
from tallymill.session import scratch_path, settings, stored
from tallymill.sources import tables
from tallymill.sources.lines import COLUMNS, order_lines, source_table

FACT = "order_id bigint, customer_key int, product_key int, order_date date, sales decimal(12,4), profit decimal(12,4), quantity bigint"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def shuffle_files(spark) -> set:
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}


def shuffles(spark) -> int:
    return spark.sparkContext._jsc.sc().newShuffleId()


def rows(df) -> Counter:
    return Counter(map(tuple, df.collect()))


def test_a_finished_write_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    wide = spark.range(20_000).repartition(8, "id")
    stored(wide, "freed")
    tables.write_table(wide.withColumn("k", F.col("id") % 3), scratch_path(spark, "freed"), ["k"])
    for _ in range(50):  # they are removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_settings_are_put_back(spark):
    with pytest.raises(KeyError), settings(spark, {"spark.sql.shuffle.partitions": "3", "tallymill.test": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise KeyError
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8" and spark.conf.get("tallymill.test", None) is None


def test_large_tables_are_written_where_their_rows_are(spark):
    df = spark.range(0, 1_000, 1, 4).select("id", F.when(F.col("id") % 50 > 0, F.col("id") % 50).alias("k"))
    path, first = scratch_path(spark, "large"), shuffles(spark)
    tables.write_table(df, path, ["k"], large=True)  # more values than files open at a time
    assert shuffles(spark) == first + 1
    assert rows(tables.read_table(spark, path).select("id", "k")) == rows(df)


def test_bronze_is_not_shuffled(spark, folder):
    raw = stored(source_table(spark, folder, "nation"), "raw")
    first = shuffles(spark)
    bronze = tables.ingest_bronze(spark, raw, scratch_path(spark, "bronze"), ["n_regionkey"])
    assert shuffles(spark) <= first + 2  # the count of what is stored
    assert rows(bronze.select(raw.columns)) == rows(raw)


def plain_lines(spark, folder, *columns, region=True):
    """Lines by plain joins."""
    t = {n: source_table(spark, folder, n) for n in ("lineitem", "orders", "customer", "nation", "region", "part")}
    joined = t["lineitem"].join(t["orders"], F.expr("l_orderkey = o_orderkey")).join(t["customer"], F.expr("o_custkey = c_custkey"))
    joined = joined.join(t["nation"], F.expr("c_nationkey = n_nationkey")).join(t["part"], F.expr("l_partkey = p_partkey"))
    if region:
        joined = joined.join(t["region"], F.expr("n_regionkey = r_regionkey"))
    return joined.select(*(F.expr(COLUMNS[c][1]).alias(c) for c in columns))


def test_names_of_nations_come_last_and_keys_may_repeat(spark, folder, tmp_path):
    for name in ("lineitem", "orders", "customer", "part"):
        key = {"lineitem": "l_orderkey", "orders": "o_orderkey", "customer": "c_custkey", "part": "p_partkey"}[name]
        source_table(spark, folder, name).filter(F.col(key) < 150).write.parquet(f"{tmp_path}/{name}.parquet")
    nations = [(k, f"N{k}", k % 2) for k in range(20)] + [(1, "N1", 1), (2, "other", 1), (3, None, 0), (None, "none", 0), (4, "lost", None)]
    spark.createDataFrame(nations, "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "A"), (1, "B"), (1, "C")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    lines = order_lines(spark, str(tmp_path))
    assert rows(lines.drop("row_id")) == rows(plain_lines(spark, str(tmp_path), *(c for c in COLUMNS if c != "row_id")))
    assert lines.groupBy("order_id", "row_id").count().filter("count > 1").isEmpty()
    text = plan(lines)
    assert text.index("[n_regionkey") < text.index("[n_nationkey") < text.index("[l_partkey")  # the last join is the first of the plan
    some = ("state", "postal_code", "category")
    assert rows(order_lines(spark, str(tmp_path), *some)) == rows(plain_lines(spark, str(tmp_path), *some, region=False))


@pytest.fixture(scope="module")
def fact(spark):
    d = dt.date
    return spark.createDataFrame([
        (1, 1, 1, d(2024, 1, 31), Decimal("1.005"), Decimal("0.1"), 1), (1, 1, 2, d(2024, 1, 31), Decimal("2.005"), None, 2),
        (1, 2, 1, d(2024, 2, 1), None, Decimal("-1"), None), (2, 2, 1, d(2023, 2, 1), Decimal(4), Decimal(1), 3),
        (None, 2, 2, d(2024, 1, 1), Decimal(5), Decimal(1), 1), (3, None, None, None, Decimal(7), Decimal(1), 1),
        (2, 2, 1, d(2023, 2, 1), Decimal(4), Decimal(1), 3), (4, 1, 3, None, None, None, None),
    ], FACT)


def test_orders_counted_apart_are_the_same(fact):
    months = sales.monthly_revenue(fact, apart=True)
    assert months.schema == sales.monthly_revenue(fact).schema and rows(months) == rows(sales.monthly_revenue(fact))
    found = {(r.year, r.month): (r.month_name, r.revenue, r.orders) for r in months.collect()}
    assert found[2024, 1] == ("Jan", 8.01, 1) and found[2023, 2] == ("Feb", 8.0, 1) and found[None, None] == (None, 7.0, 2)


def test_products_meet_their_dimension_as_totals(spark, fact):
    products = spark.createDataFrame([(1, "P1", "a", "c", "s"), (2, "P2", "b", "c", "s"), (3, "P3", "b", "d", "s")],
                                     "product_key int, product_id string, product_name string, category string, sub_category string")
    totals, lines = (star.star_lines(f, products=products) for f in (star.product_totals(fact), fact))
    assert totals.count() == 3
    for aggregate in (sales.revenue_by_category, sales.top_products):
        assert rows(aggregate(totals)) == rows(aggregate(lines)) and aggregate(totals).schema == aggregate(lines).schema


def test_customers_dealt_out_once(spark, fact):
    names = spark.createDataFrame([(1, "C1", "Ann", "Home"), (2, "C2", "Bob", None)], "customer_key int, customer_id string, customer_name string, segment string")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        base = customers.rfm_base(star.star_lines(fact, customers=names), dt.date(2024, 3, 1))
        assert plan(base).count("Exchange hashpartitioning") == 2  # both sides of the join
        assert rows(base) == Counter([("C1", "Ann", "Home", 30, 2, 3.01), ("C2", "Bob", None, 29, 2, 13.0)])


def test_the_warehouse_is_the_same_from_totals(spark, folder):
    built = batch.build_warehouse(spark, stored(order_lines(spark, folder), "raw"), scratch_path(spark, "warehouse"))
    by_product = star.star_lines(built["fact_sales"], products=built["dim_product"])
    assert rows(built["revenue_by_category"]) == rows(sales.revenue_by_category(by_product))
    assert rows(built["top_products"]) == rows(sales.top_products(by_product))
    assert batch.verify_warehouse(built).filter("NOT passed").isEmpty()


def test_the_checks_of_a_run_leave_no_shuffle_files(spark, folder, monkeypatch):
    raw = stored(order_lines(spark, folder).filter("order_id % 20 = 1"), "raw")
    seen, real = [], batch.verify_warehouse

    def verify(built):
        seen.append(shuffle_files(spark))
        return real(built)

    def stop(*_):
        for _ in range(50):
            if not shuffle_files(spark) - seen[0]:
                raise InterruptedError
            time.sleep(0.1)

    monkeypatch.setattr(batch, "verify_warehouse", verify)
    monkeypatch.setattr(batch, "build_models", stop)
    with pytest.raises(InterruptedError):
        batch.run_batch(spark, raw, scratch_path(spark, "run"), dt.datetime(2024, 1, 31))
