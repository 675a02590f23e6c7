"""The star schema: five dimensions and the sales fact.

Surrogate keys are dense integers in natural-key order. When one id comes with
different attributes, the smallest attribute row is kept, so a rebuild gives
the same dimension.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.expressions import calendar_parts, date_key
from tallymill.functions.unions import union_rows
from tallymill.operators.ranges import row_numbers

PLACE = ("country", "region", "state", "city", "postal_code")
MEASURES = ("sales", "quantity", "discount", "profit")
CALENDAR = (
    "date_key", "full_date", "year", "quarter", "month",
    "month_name", "week", "day_of_week", "day_name", "is_weekend",
)
FACT = (
    "order_id", "row_id", "customer_key", "product_key", "region_key", "ship_mode_key",
    "order_date_key", "ship_date_key", *MEASURES, "order_year",
)


def distinct_by_key(df: DataFrame, key: str, *attributes: str) -> DataFrame:
    """One row per non-null key: the one with the smallest attributes.

    The many lines are made distinct first, which hashes and combines before
    the shuffle; only what is left is compared as structs, which has to sort.
    """
    found = df.filter(F.col(key).isNotNull()).select(key, *attributes).distinct()
    smallest = F.min(F.struct(*attributes)).alias("_row")
    return found.groupBy(key).agg(smallest).select(key, "_row.*")


def surrogate_key(df: DataFrame, name: str, *natural_key: str) -> DataFrame:
    """``df`` with a leading dense integer key in natural-key order."""
    keyed = row_numbers(df, name, *natural_key)
    return keyed.select(F.col(name).cast("int").alias(name), *df.columns)


def dim_customer(lines: DataFrame) -> DataFrame:
    rows = distinct_by_key(lines, "customer_id", "customer_name", "segment")
    return surrogate_key(rows, "customer_key", "customer_id")


def dim_product(lines: DataFrame) -> DataFrame:
    rows = distinct_by_key(lines, "product_id", "product_name", "category", "sub_category")
    return surrogate_key(rows, "product_key", "product_id")


def dim_region(lines: DataFrame) -> DataFrame:
    """Distinct places; a missing part of a place is a value of its own."""
    return surrogate_key(lines.select(*PLACE).distinct(), "region_key", *PLACE)


def dim_ship_mode(lines: DataFrame) -> DataFrame:
    modes = lines.select("ship_mode").filter("ship_mode IS NOT NULL").distinct()
    return surrogate_key(modes, "ship_mode_key", "ship_mode")


def calendar_bounds(lines: DataFrame, cover: str = "both") -> DataFrame:
    """First and last day of the calendar, as one row."""
    dates = ("order_date", "ship_date") if cover == "both" else ("order_date",)
    ends = lines.agg(
        *(F.min(F.to_date(d)).alias(f"first_{d}") for d in dates),
        *(F.max(F.to_date(d)).alias(f"last_{d}") for d in dates),
    )
    first = [F.col(f"first_{d}") for d in dates]
    last = [F.col(f"last_{d}") for d in dates]
    if cover == "both":
        return ends.select(
            F.least(*first).alias("first_day"), F.greatest(*last).alias("last_day")
        )
    return ends.select(first[0].alias("first_day"), last[0].alias("last_day"))


def dim_date(lines: DataFrame, cover: str = "both") -> DataFrame:
    """One row per day; ``cover`` is ``'both'`` (order and ship dates) or ``'order'``."""
    days = calendar_bounds(lines, cover).select(
        F.explode(F.sequence("first_day", "last_day")).alias("full_date")
    )
    parts = {"date_key": date_key("full_date"), **calendar_parts("full_date")}
    return days.withColumns(parts).select(*CALENDAR)


def _same(left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> Column:
    match = F.lit(True)
    for c in columns:
        match = match & left[c].eqNullSafe(right[c])
    return match


def fact_sales(
    lines: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    regions: DataFrame,
    ship_modes: DataFrame,
    cover: str = "both",
) -> DataFrame:
    """Order lines with the dimension keys in place of the attributes.

    The joins carry no hints: a dimension is broadcast only while its measured
    size allows, and a key with very many lines is split by the adaptive skew
    join. Places and ship modes, the small dimensions with long attributes, come
    first, so that what the others shuffle holds their keys. Places match null-safely.
    The date keys are computed from the dates, after the joins; with
    ``cover='order'`` a ship date outside the order dates has no key.
    """
    customers = customers.select("customer_key", "customer_id")
    products = products.select("product_key", "product_id")
    places = regions.select("region_key", *PLACE)
    modes = ship_modes.select("ship_mode_key", "ship_mode")

    ordered, shipped = F.to_date("order_date"), F.to_date("ship_date")
    ship_key = date_key(shipped)
    if cover == "order":
        bounds = calendar_bounds(lines, cover)
        first, last = bounds.select("first_day").scalar(), bounds.select("last_day").scalar()
        ship_key = F.when(shipped.between(first, last), ship_key)

    dated = lines.filter(ordered.isNotNull())
    return (
        dated.join(places, _same(dated, places, PLACE))
        .join(modes, "ship_mode")
        .join(customers, "customer_id")
        .join(products, "product_id")
        .withColumns({
            "order_date_key": date_key(ordered),
            "ship_date_key": ship_key,
            "order_year": F.year(ordered),
        })
        .select(*FACT)
    )


def star_lines(
    fact: DataFrame,
    calendar: DataFrame | None = None,
    customers: DataFrame | None = None,
    products: DataFrame | None = None,
    regions: DataFrame | None = None,
) -> DataFrame:
    """The fact with the attributes of the given dimensions put back.

    The result has the column names of the flat order lines, so every
    aggregate takes either.
    """
    lines = fact
    if calendar is not None:
        days = calendar.select(
            F.col("date_key").alias("order_date_key"), F.col("full_date").alias("order_date")
        )
        lines = lines.join(days, "order_date_key")
    if customers is not None:
        lines = lines.join(customers, "customer_key")
    if products is not None:
        lines = lines.join(products, "product_key")
    if regions is not None:
        lines = lines.join(regions, "region_key")
    return lines


def product_totals(fact: DataFrame) -> DataFrame:
    """The fact summed per product, with the fact's column names.

    Sums are exact, so any sum over products is the same from these.
    """
    amounts = ("sales", "profit", "quantity")
    return fact.groupBy("product_key").agg(*(F.sum(c).alias(c) for c in amounts))


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys that the dimension lacks."""
    return fact.select(key).distinct().join(dimension.select(key), key, "left_anti")


def insert_if_absent(target: DataFrame, rows: DataFrame, *key: str) -> DataFrame:
    """``target`` plus the rows whose key it lacks, one row per new key."""
    others = [c for c in target.columns if c not in key]
    match = F.lit(True)
    fresh = rows.select(*target.columns).distinct().groupBy(*key).agg(F.min(F.struct(*others)).alias("_row")).select(*key, "_row.*")
    for c in key:
        match = match & fresh[c].eqNullSafe(target[c])
    return union_rows([target, fresh.join(target, match, "left_anti")])
