"""Data-quality checks that return rows instead of raising.

Every check yields (check_name, table_name, column_name, failures, passed).
Rules about single rows are collected and evaluated in one pass per table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.unions import union_rows


@dataclass(frozen=True)
class Rule:
    """A row rule: ``broken`` is true for a row that breaks it."""

    check: str
    column: str
    broken: Column


def not_null(*columns: str) -> list[Rule]:
    return [Rule("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_values(column: str, values: Sequence) -> list[Rule]:
    return [Rule("accepted_values", column, ~F.col(column).isin(list(values)))]


def expression_true(expression: str) -> list[Rule]:
    return [Rule("expression_true", expression, ~F.expr(expression))]


def value_range(column: str, low=None, high=None, above=None) -> list[Rule]:
    """Inclusive ``low``/``high``; ``above`` is an exclusive lower bound."""
    value = F.col(column)
    tests = [value < low if low is not None else None,
             value > high if high is not None else None,
             value <= above if above is not None else None]
    return [Rule("range", column, reduce(Column.__or__, [t for t in tests if t is not None]))]


def no_future_dates(column: str, as_of: dt.date) -> list[Rule]:
    return [Rule("no_future_dates", column, F.col(column) > F.lit(as_of))]


def weekend_flag(day_of_week: str = "day_of_week", flag: str = "is_weekend") -> list[Rule]:
    return [Rule("weekend_flag", flag, F.col(day_of_week).isin(1, 7) != F.col(flag))]


def _finding(check: str, table: str, column: str, failures: Column) -> list[Column]:
    count = F.coalesce(failures, F.lit(0)).cast("bigint")
    return [
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"), count.alias("failures"), (count == 0).alias("passed"),
    ]


def check_rows(df: DataFrame, table: str, *rules: Rule) -> DataFrame:
    """All row rules of a table in a single aggregation."""
    counted = df.agg(*(F.count_if(r.broken).alias(f"_{i}") for i, r in enumerate(rules)))
    return counted.select(F.inline(F.array(*(
        F.struct(*_finding(r.check, table, r.column, F.col(f"_{i}")))
        for i, r in enumerate(rules)
    ))))


def unique(df: DataFrame, table: str, *key: str) -> DataFrame:
    """Failures are the rows beyond the first of each non-null key."""
    counts = df.dropna(subset=list(key)).groupBy(*key).count()
    surplus = counts.agg(F.sum(F.col("count") - 1).alias("n"))
    return surplus.select(*_finding("unique", table, ",".join(key), F.col("n")))


def referential_integrity(
    fact: DataFrame, key: str, dimension: DataFrame, table: str, dimension_key: str | None = None
) -> DataFrame:
    """Failures are the distinct fact keys that the dimension lacks."""
    known = dimension.select(F.col(dimension_key or key).alias(key))
    used = fact.select(key).filter(F.col(key).isNotNull()).distinct()
    lost = used.join(known, key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
    return lost.select(*_finding("referential_integrity", table, key, F.col("n")))


def _difference(left: DataFrame, right: DataFrame, total: Column) -> DataFrame:
    sides = union_rows([left.agg(total.alias("n")), right.agg((-total).alias("n"))])
    return sides.agg(F.abs(F.sum("n")).alias("n"))


def row_count_parity(left: DataFrame, right: DataFrame, table: str) -> DataFrame:
    """Failures are the rows one side has more than the other."""
    gap = _difference(left, right, F.count(F.lit(1)))
    return gap.select(*_finding("row_count_parity", table, "*", F.col("n")))


def measure_parity(
    left: DataFrame, right: DataFrame, table: str, column: str, tolerance: float = 0.01
) -> DataFrame:
    """One failure when the two sums differ by more than the tolerance."""
    gap = _difference(left, right, F.sum(F.col(column).cast("decimal(28,4)")))
    apart = (F.col("n").cast("double") > tolerance).cast("bigint")
    return gap.select(*_finding("measure_parity", table, column, apart))


def calendar_continuous(calendar: DataFrame, table: str, day: str = "full_date") -> DataFrame:
    """Failures are the days missing between the first and the last."""
    days = calendar.agg(
        F.abs(F.datediff(F.max(day), F.min(day)) + 1 - F.count(F.lit(1))).alias("n")
    )
    return days.select(*_finding("calendar_continuous", table, day, F.col("n")))


def row_bounds(
    df: DataFrame, table: str, low: int, high: int | None = None, distinct: str | None = None
) -> DataFrame:
    """One failure when the rows (or distinct values) fall outside the bounds."""
    if distinct:
        df = df.filter(F.col(distinct).isNotNull()).select(distinct).distinct()
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    outside = F.col("n") < low
    if high is not None:
        outside = outside | (F.col("n") > high)
    return counted.select(*_finding("row_bounds", table, distinct or "*", outside.cast("bigint")))


def one_winner_per_month(forecast: DataFrame, table: str, *keys: str) -> DataFrame:
    """Failures are the months without exactly one winning row."""
    winners = forecast.groupBy(*keys, "forecast_month").agg(
        F.count_if(F.col("is_winner")).alias("winners")
    )
    wrong = winners.agg(F.count_if(F.col("winners") != 1).alias("n"))
    return wrong.select(*_finding("one_winner_per_month", table, "is_winner", F.col("n")))


def segment_ordering(
    segments: DataFrame, table: str, fresher: str = "Champions", staler: str = "Lost"
) -> DataFrame:
    """One failure unless the first segment ordered more recently on average."""
    label, recency = F.col("cluster_label"), F.col("recency_days")
    means = segments.agg(
        F.avg(F.when(label == fresher, recency)).alias("a"),
        F.avg(F.when(label == staler, recency)).alias("b"),
    )
    wrong = F.coalesce((F.col("a") >= F.col("b")).cast("bigint"), F.lit(0))
    return means.select(*_finding("segment_ordering", table, "recency_days", wrong))


def report(*findings: DataFrame) -> DataFrame:
    return union_rows(findings)
