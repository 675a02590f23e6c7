"""Whole-table numbering, ranking and running totals without one big task.

A window without a partition key sends every row to one task. Here the rows
are range-partitioned on the ordering, numbered inside their slice while the
slice is written, and moved up by what the slices before hold. Only one small
row per slice meets in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.session import stored

_POSITION_BITS = 33  # layout of monotonically_increasing_id


def range_slices(df: DataFrame, *order: Column | str) -> DataFrame:
    """``df`` plus ``_slice`` (its range) and ``_pos`` (from 1 inside it).

    Slices are in the given order. The table is written because range bounds
    come from a sample and could differ when computed again.
    """
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    at = F.col("_at")
    return (
        stored(numbered, "slices")
        .withColumn("_slice", F.shiftright(at, _POSITION_BITS))
        .withColumn("_pos", at.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)) + 1)
        .drop("_at")
    )


def slice_starts(sliced: DataFrame, amount: Column, name: str, *within: str) -> DataFrame:
    """Per slice, the total of ``amount`` (an aggregate) over the slices before.

    One row per slice (and value of ``within``), so no more rows than
    shuffle partitions: small enough for one task and to broadcast.
    """
    before = (
        Window.partitionBy(*within).orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = sliced.groupBy(*within, "_slice").agg(amount.alias("_total"))
    start = F.coalesce(F.sum("_total").over(before), F.lit(0))
    return F.broadcast(totals.select(*within, "_slice", start.alias(name)))


def row_numbers(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """``df`` with ``name`` = 1, 2, 3 … in the given order (make it unique)."""
    sliced = range_slices(df, *order)
    starts = slice_starts(sliced, F.count(F.lit(1)), "_start")
    return (
        sliced.join(starts, "_slice")
        .withColumn(name, F.col("_start") + F.col("_pos"))
        .drop("_slice", "_pos", "_start")
    )


def running_total(df: DataFrame, amount: str, name: str, *order: Column | str) -> DataFrame:
    """``df`` with the sum of ``amount`` over all rows up to the current one."""
    sliced = range_slices(df, *order)
    starts = slice_starts(sliced, F.sum(amount), "_start")
    inside = (
        Window.partitionBy("_slice").orderBy("_pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.withColumn("_sum", F.sum(amount).over(inside))
        .join(starts, "_slice")
        .withColumn(name, F.col("_start") + F.col("_sum"))
        .drop("_slice", "_pos", "_start", "_sum")
    )


def ntile_bucket(rank: Column, rows: Column, buckets: int) -> Column:
    """The SQL NTILE bucket of a row with this rank among ``rows`` rows."""
    small = F.floor(rows / buckets)
    larger = rows % buckets
    edge = larger * (small + 1)
    return (
        F.when(rank <= edge, F.floor((rank - 1) / (small + 1)) + 1)
        .otherwise(larger + F.floor((rank - 1 - edge) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def quantile_bucket(rank: Column, rows: Column, buckets: int) -> Column:
    """The bucket from cutting ranks 1…n at their linear quantiles."""
    last = F.greatest(rows - 1, F.lit(1))
    return F.greatest(F.lit(1), F.ceil((rank - 1) * buckets / last)).cast("int")


BUCKETS = {"ntile": ntile_bucket, "qcut": quantile_bucket}


def bucket_columns(
    df: DataFrame, key: str, metrics: Sequence[tuple[str, str]], buckets: int, method: str
) -> DataFrame:
    """Bucket each row by each metric, smallest values first, ties by ``key``.

    ``metrics`` holds (metric column, bucket column) pairs; ``key`` is unique.
    All metrics are ranked in one range shuffle: a row becomes one entry per
    metric, the first of which carries the row itself.
    """
    layout = df.schema.simpleString()
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    entries = F.array(*(
        F.struct(
            F.lit(i).alias("metric"),
            F.col(metric).cast("decimal(28,4)").alias("value"),
            F.col(key).alias("key"),
            (row if i == 0 else F.lit(None)).cast(layout).alias("row"),
        )
        for i, (metric, _) in enumerate(metrics)
    ))
    ranked = row_numbers(df.select(F.inline(entries)), "place", "metric", "value", "key")
    rows = ranked.filter("metric = 0").agg(F.count(F.lit(1))).scalar()
    bucketed = ranked.withColumn(
        "bucket", BUCKETS[method](F.col("place") - F.col("metric") * rows, rows, buckets)
    )
    return (
        bucketed.groupBy("key")
        .agg(
            F.first("row", ignorenulls=True).alias("row"),
            *(
                F.max(F.when(F.col("metric") == i, F.col("bucket"))).alias(name)
                for i, (_, name) in enumerate(metrics)
            ),
        )
        .select("row.*", *(name for _, name in metrics))
    )
