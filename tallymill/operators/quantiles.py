"""Exact quantiles and what builds on them, without collecting a column.

Values are counted first (combined before the shuffle), the distinct values
are range-partitioned, and the cumulative counts say which value sits at which
rank. No task sees more than its own range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.operators.ranges import range_slices, slice_starts


def long_form(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """One (column_name, value) row per column and row of ``df``."""
    cells = (
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast(kind).alias("value"))
        for c in columns
    )
    return df.select(F.inline(F.array(*cells)))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Stored (column_name, value, n) with ranks: the value fills the 0-based
    places ``first`` up to, not including, ``after``."""
    present = F.col("value").isNotNull() & ~F.isnan("value")
    counts = (
        long_form(df, columns).filter(present)
        .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    sliced = range_slices(counts, "column_name", "value")
    starts = slice_starts(sliced, F.sum("n"), "_start", "column_name")
    inside = (
        Window.partitionBy("column_name", "_slice").orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.withColumn("_upto", F.sum("n").over(inside))
        .join(starts, ["column_name", "_slice"])
        .withColumn("after", F.col("_start") + F.col("_upto"))
        .withColumn("first", F.col("after") - F.col("n"))
        .select("column_name", "value", "n", "first", "after")
    )


def quantiles(counts: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(column_name, probability, quantile), linear between neighbouring ranks."""
    place = F.col("probability") * (F.col("rows") - 1)
    wanted = (
        counts.groupBy("column_name").agg(F.sum("n").alias("rows"))
        .withColumn("probability", F.explode(F.array(*(F.lit(p) for p in probabilities))))
        .select(
            "column_name", "probability",
            F.floor(place).alias("low"), F.ceil(place).alias("high"), place.alias("place"),
        )
    )

    def holds(rank: str) -> Column:
        return (F.col(rank) >= F.col("first")) & (F.col(rank) < F.col("after"))

    # one row per column and probability: bounded by the arguments
    hits = counts.join(F.broadcast(wanted), "column_name").filter(holds("low") | holds("high"))
    ends = hits.groupBy("column_name", "probability").agg(
        F.max(F.when(holds("low"), F.col("value"))).alias("low_value"),
        F.max(F.when(holds("high"), F.col("value"))).alias("high_value"),
        F.first(F.col("place") - F.col("low")).alias("part"),
    )
    value = F.col("low_value") + (F.col("high_value") - F.col("low_value")) * F.col("part")
    return ends.select("column_name", "probability", value.alias("quantile"))


def quantile_columns(counts: DataFrame, **probabilities: float) -> DataFrame:
    """One row per column with a quantile in each named output column."""
    table = quantiles(counts, list(probabilities.values()))
    return table.groupBy("column_name").agg(*(
        F.round(F.max(F.when(F.col("probability") == p, F.col("quantile"))), 8).alias(name)
        for name, p in probabilities.items()
    ))


def iqr_outliers(counts: DataFrame, reach: float = 1.5) -> DataFrame:
    """Values further than ``reach`` interquartile ranges outside the quartiles."""
    spread = F.col("q3") - F.col("q1")
    bounds = quantile_columns(counts, q1=0.25, q3=0.75).select(
        "column_name",
        (F.col("q1") - reach * spread).alias("lower_bound"),
        (F.col("q3") + reach * spread).alias("upper_bound"),
    )
    outside = ~F.col("value").between(F.col("lower_bound"), F.col("upper_bound"))
    counted = (
        counts.join(F.broadcast(bounds), "column_name")  # one row per profiled column
        .groupBy("column_name", "lower_bound", "upper_bound")
        .agg(
            F.coalesce(F.sum(F.when(outside, F.col("n"))), F.lit(0)).alias("outliers"),
            F.sum("n").alias("rows"),
        )
    )
    return counted.select(
        "column_name",
        F.round("lower_bound", 8).alias("lower_bound"),
        F.round("upper_bound", 8).alias("upper_bound"),
        "outliers",
        F.round(100.0 * F.col("outliers") / F.col("rows"), 4).alias("outlier_pct"),
    )
