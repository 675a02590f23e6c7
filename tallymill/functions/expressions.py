"""Small column expressions used across the operators.

Amounts are summed as decimals and turned into doubles only when a finished
number is served, so totals do not depend on the order of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The customer segments and the score rules that name them,
# checked from the first to the last.
SEGMENT_RULES = (
    ("Champions", "r_score >= 4 AND f_score >= 4 AND m_score >= 4"),
    ("Loyal Customers", "r_score >= 3 AND f_score >= 4 AND m_score >= 3"),
    ("Potential Loyalists", "r_score >= 4 AND f_score >= 2 AND m_score >= 2"),
    ("At Risk", "r_score <= 2 AND f_score >= 3 AND m_score >= 3"),
    ("Lost", "r_score <= 2 AND f_score <= 2 AND m_score <= 2"),
    ("New Customers", "r_score >= 4 AND f_score = 1"),
)
OTHER_SEGMENT = "Need Attention"
SEGMENTS = tuple(label for label, _ in SEGMENT_RULES) + (OTHER_SEGMENT,)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def cents(amount: Column | str, scale: int = 2) -> Column:
    """An amount rounded to ``scale`` places, served as a double."""
    return F.round(_column(amount), scale).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``, NULL where ``whole`` is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    return F.round(F.lit(100.0) * ratio(part, whole), scale)


def exact_ratio(amount: Column, count: Column, scale: int = 2) -> Column:
    """An amount per counted thing, divided as decimals and rounded half up.

    The types leave room for totals up to 10^20 and counts up to 10^13.
    """
    part = F.try_divide(amount.cast("decimal(24,4)"), count.cast("decimal(13,0)"))
    return F.round(part, scale).cast("double")


def mean(amount: Column | str, scale: int = 2) -> Column:
    """Aggregate: the mean of a decimal or whole-number column, rounded."""
    return exact_ratio(F.sum(amount), F.count(amount), scale)


def date_key(day: Column | str) -> Column:
    """A date as the integer YYYYMMDD."""
    return F.date_format(day, "yyyyMMdd").cast("int")


def month_start(day: Column | str) -> Column:
    return F.trunc(_column(day), "month")


def calendar_parts(day: Column | str) -> dict[str, Column]:
    """The calendar attributes of a date; the week starts on Sunday as day 1."""
    day = _column(day)
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMM"),
        "week": F.weekofyear(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEE"),
        "is_weekend": F.dayofweek(day).isin(1, 7),
    }


def typed(column: str, data_type: str) -> Column:
    """Text to ``data_type``; blanks and unreadable values become NULL."""
    return F.expr(f"try_cast(nullif(trim(cast(`{column}` AS string)), '') AS {data_type})")


def missing_as_null(column: Column | str) -> Column:
    """NaN and NULL both as NULL."""
    column = _column(column)
    return F.when(F.isnan(column), None).otherwise(column)


def segment_label() -> Column:
    """The segment name for the scores in r_score, f_score and m_score."""
    (first, rule), *others = SEGMENT_RULES
    label = F.when(F.expr(rule), first)
    for name, rule in others:
        label = label.when(F.expr(rule), name)
    return label.otherwise(OTHER_SEGMENT)


def score_text() -> Column:
    return F.concat(*(F.col(c).cast("string") for c in ("r_score", "f_score", "m_score")))


def age_seconds(as_of: Column, moment: Column) -> Column:
    return (F.unix_timestamp(as_of.cast("timestamp"))
            - F.unix_timestamp(moment.cast("timestamp"))).cast("bigint")


def mape(actual: Column, predicted: Column) -> Column:
    """Aggregate: mean absolute percentage error over the nonzero actuals."""
    return F.avg(F.when(actual != 0, F.abs((actual - predicted) / actual))) * 100


def rmse(actual: Column, predicted: Column) -> Column:
    """Aggregate: root mean squared error."""
    return F.sqrt(F.avg((actual - predicted) * (actual - predicted)))
