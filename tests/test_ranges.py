"""Distributed numbering, buckets, running totals and quantiles."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallymill.operators import quantiles, ranges
from tallymill.sources.lines import _number_lines


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value; ``id`` is unique."""
    return spark.range(5000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 37 % 1009).alias("v"),
    )


def test_row_numbers_equal_the_global_window(spark, skewed):
    ours = {r["id"]: r["n"] for r in ranges.row_numbers(skewed, "n", F.desc("v"), "id").collect()}
    window = Window.orderBy(F.desc("v"), "id")
    theirs = {
        r["id"]: r["n"] for r in skewed.withColumn("n", F.row_number().over(window)).collect()
    }
    assert ours == theirs


def test_rows_are_spread_over_slices(spark, skewed):
    wide = skewed.withColumn("text", F.repeat(F.lit("x"), 2000))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in
                 ranges.range_slices(wide, "v", "id").groupBy("_slice").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 4 and max(sizes) < 5000 / 3


def test_running_total_equals_the_global_window(spark, skewed):
    ours = ranges.running_total(skewed, "v", "s", "v", "id")
    window = Window.orderBy("v", "id").rowsBetween(Window.unboundedPreceding, 0)
    theirs = skewed.withColumn("s", F.sum("v").over(window))
    assert ours.select("id", "s").exceptAll(theirs.select("id", "s")).isEmpty()


@pytest.mark.parametrize("n", [1, 3, 5, 7, 11, 23, 800])
def test_buckets_with_ties(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.randint(0, 5), rng.randint(0, 100)) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, a int, b int")
    out = ranges.bucket_columns(df, "id", [("a", "qa"), ("b", "qb")], 5, "ntile")
    expected = df.select(
        "*",
        F.ntile(5).over(Window.orderBy("a", "id")).alias("qa"),
        F.ntile(5).over(Window.orderBy("b", "id")).alias("qb"),
    )
    assert sorted(out.collect()) == sorted(expected.collect())


@pytest.mark.parametrize("n", [7, 23, 793])
def test_qcut_buckets_equal_pandas(spark, n):
    rng = random.Random(n)
    frame = pd.DataFrame({"id": range(n), "a": [rng.randint(0, 9) for _ in range(n)]})
    expected = pd.qcut(frame["a"].rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    out = ranges.bucket_columns(spark.createDataFrame(frame), "id", [("a", "q")], 5, "qcut")
    assert [r["q"] for r in out.orderBy("id").collect()] == expected.tolist()


def test_lines_of_a_hot_order_get_distinct_numbers(spark):
    """One order with a third of all lines, some of them identical."""
    lines = spark.range(3000).select(
        F.when(F.col("id") < 1000, 1).otherwise(F.col("id")).alias("l_orderkey"),
        (F.col("id") % 200).alias("l_partkey"), (F.col("id") % 10).alias("l_suppkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"),
        *(F.lit(1.0).alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")),
        F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
        F.lit(0).alias("l_shipdate"),
    )
    numbers = [r["row_id"] for r in
               _number_lines(lines).filter("l_orderkey = 1").select("row_id").collect()]
    assert len(set(numbers)) == len(numbers) == 1000


def test_quantiles_equal_numpy(spark, skewed):
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    columns = skewed.withColumn("w", F.col("id") * 0.5)
    counts = quantiles.value_counts(columns, ["v", "w"])
    found = {(r[0], r[1]): r[2] for r in quantiles.quantiles(counts, probabilities).collect()}
    frame = columns.toPandas()
    for c in ("v", "w"):
        expected = np.quantile(frame[c], probabilities)
        assert [found[c, p] for p in probabilities] == pytest.approx(expected)


def test_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in [*range(20), 500, -400]], "v double")
    row = quantiles.iqr_outliers(quantiles.value_counts(df, ["v"])).first()
    assert (row["outliers"], row["outlier_pct"]) == (2, round(100 * 2 / 22, 4))
