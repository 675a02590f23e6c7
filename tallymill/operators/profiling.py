"""Profiles of a table, each in one pass over its rows."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.expressions import cents, month_start
from tallymill.functions.unions import union_rows
from tallymill.operators.quantiles import long_form, quantile_columns, value_counts
from tallymill.session import stored


def _rows(columns: Sequence[str], **fields) -> Column:
    """An array with one struct per column; each field is a function of its name."""
    return F.inline(F.array(*(
        F.struct(F.lit(c).alias("column_name"), *(f(c).alias(n) for n, f in fields.items()))
        for c in columns
    )))


def profile_columns(df: DataFrame) -> DataFrame:
    """Type, present and missing values and distinct values of every column."""
    types = dict(df.dtypes)
    kind = F.create_map(*(F.lit(x) for pair in types.items() for x in pair))
    cells = long_form(df, df.columns, "string")
    values = cells.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    return values.groupBy("column_name").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
        .alias("non_null"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
        .alias("null_count"),
        F.count("value").alias("distinct_count"),
    ).select(
        "column_name",
        kind[F.col("column_name")].alias("data_type"),
        "non_null",
        "null_count",
        F.round(
            100.0 * F.col("null_count") / (F.col("null_count") + F.col("non_null")), 2
        ).alias("null_pct"),
        "distinct_count",
    )


def profile_nulls(profile: DataFrame) -> DataFrame:
    """The columns that have missing values."""
    return profile.filter("null_count > 0").select("column_name", "null_count", "null_pct")


def profile_dates(df: DataFrame, *columns: str) -> DataFrame:
    """First and last day, span, and values that are no date."""
    day = {c: F.expr(f"try_cast(`{c}` AS date)") for c in columns}
    ends = df.agg(
        *(F.min(day[c]).alias(f"{c}_min") for c in columns),
        *(F.max(day[c]).alias(f"{c}_max") for c in columns),
        *(F.count_if(day[c].isNull()).alias(f"{c}_bad") for c in columns),
    )
    return ends.select(_rows(
        columns,
        first_day=lambda c: F.col(f"{c}_min"),
        last_day=lambda c: F.col(f"{c}_max"),
        span_days=lambda c: F.datediff(f"{c}_max", f"{c}_min"),
        invalid_rows=lambda c: F.col(f"{c}_bad"),
    ))


def rows_per_day(df: DataFrame, column: str) -> DataFrame:
    """Distinct days, mean rows per day and the busiest day (earliest of equals)."""
    days = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("day")).count()
    busiest = F.max(F.struct("count", (-F.unix_date("day")).alias("early"), "day"))
    return days.agg(
        F.count(F.lit(1)).alias("distinct_days"),
        F.round(F.sum("count") / F.count(F.lit(1)), 1).alias("avg_rows_per_day"),
        busiest.alias("_top"),
    ).select(
        "distinct_days", "avg_rows_per_day",
        F.col("_top.day").alias("busiest_day"), F.col("_top.count").alias("busiest_rows"),
    )


def profile_duplicates(df: DataFrame, pair: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """(measure, rows): repeated rows, repeated key pairs, distinct ids.

    ``df`` is written once and read for each measure. A row that no other shares
    its hash with is not repeated, so whole rows are compared only among the
    others, whose hashes are counted and written first.
    """
    df = stored(df, "profiled")
    alike = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    hashes = stored(df.groupBy(alike.alias("_hash")).count().filter("count > 1").select("_hash"), "repeated-hashes")
    likely = df.join(hashes, alike == F.col("_hash"), "left_semi")
    whole = likely.groupBy(*df.columns).count().agg(_surplus("duplicate_rows"))
    pairs = df.groupBy(*pair).count().agg(_surplus("duplicate_" + "_".join(pair)))
    distinct = (
        long_form(df, ids, "string").filter("value IS NOT NULL").distinct()
        .groupBy(F.concat(F.lit("distinct_"), "column_name").alias("measure"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return union_rows([whole.select("m.*"), pairs.select("m.*"), distinct])


def _surplus(measure: str) -> Column:
    extra = F.coalesce(F.sum(F.col("count") - 1), F.lit(0))
    return F.struct(F.lit(measure).alias("measure"), extra.alias("rows")).alias("m")


def weighted_moments(counts: DataFrame) -> DataFrame:
    """Count, mean, deviation and extremes per column from stored (column_name, value, n).

    The deviation is taken around the mean, in a second pass over the distinct
    values; one value alone has none.
    """
    n, value = F.col("n"), F.col("value")
    totals = counts.groupBy("column_name").agg(
        F.sum("n").alias("rows"), (F.sum(n * value) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    # one row per profiled column
    apart = counts.join(F.broadcast(totals), "column_name").groupBy("column_name", "rows", "mean", "min", "max").agg(
        F.sum(n * (value - F.col("mean")) * (value - F.col("mean"))).alias("_squares")
    )
    std = F.sqrt(F.try_divide("_squares", F.col("rows") - 1))
    return apart.select("column_name", "rows", "mean", std.alias("std"), "min", "max")


def profile_numeric(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per column, from one scan."""
    counts = value_counts(df, columns)
    moments = weighted_moments(counts).withColumns({c: F.round(c, 4) for c in ("mean", "std")})
    return moments.join(quantile_columns(counts, q1=0.25, median=0.5, q3=0.75), "column_name")


def negative_values(df: DataFrame, *columns: str) -> DataFrame:
    counted = df.agg(*(F.count_if(F.col(c) < 0).alias(c) for c in columns))
    return counted.select(_rows(columns, negatives=F.col))


def monthly_resample(df: DataFrame, day: str, amount: str) -> DataFrame:
    """The amount summed per month from the first to the last, empty months 0."""
    sums = df.filter(F.col(day).isNotNull()).groupBy(month_start(day).alias("month")).agg(
        cents(F.sum(amount)).alias("total")
    )
    ends = sums.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    months = ends.select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("month")
    )
    return months.join(sums, "month", "left").select(
        "month", F.coalesce("total", F.lit(0.0)).alias("total")
    )


def correlation_matrix(df: DataFrame, *columns: str) -> DataFrame:
    """Pearson correlation of every pair of columns, in both directions."""
    number = {c: F.col(c).cast("double") for c in columns}
    pairs = list(combinations_with_replacement(columns, 2))
    values = df.agg(*(F.corr(number[a], number[b]).alias(f"{a}|{b}") for a, b in pairs))
    cells = [(a, b, f"{a}|{b}") for a, b in pairs] + [(b, a, f"{a}|{b}") for a, b in pairs if a != b]
    return values.select(F.inline(F.array(*(
        F.struct(
            F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
            F.round(F.col(f"`{name}`"), 3).alias("correlation"),
        )
        for a, b, name in cells
    ))))


def histogram(df: DataFrame, *columns: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins from 1; the last bin includes the maximum."""
    cells = long_form(df, columns).filter("value IS NOT NULL")
    # one row per column: bounded by the arguments
    ends = F.broadcast(
        cells.groupBy("column_name").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    )
    spread = F.col("hi") - F.col("lo")
    place = F.floor(F.try_divide((F.col("value") - F.col("lo")) * bins, spread)) + 1
    index = F.least(F.coalesce(place, F.lit(1)), F.lit(bins)).cast("int")
    return (
        cells.join(ends, "column_name")
        .groupBy("column_name", index.alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    )
