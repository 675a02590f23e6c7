"""What round 3 found: lines put together once, narrow rows in the shuffles, repeated rows told by hash."""

import contextlib
import io

from tallymill.operators import profiling, star
from tallymill.plans.catalog import QUERIES
from tallymill.plans.registry import Source
from tallymill.sources.lines import order_lines


def test_catalog_shares_lines_of_the_same_joins(spark, folder, monkeypatch):
    calls, real = [], Source.lines
    monkeypatch.setattr(Source, "lines", lambda self, *c: calls.append(c) or real(self, *c))
    assert QUERIES["publish_catalog"](spark, folder).count() == 7
    assert len(calls) == 5  # seven tables


def test_fact_meets_the_small_dimensions_first(spark, folder):
    lines = order_lines(spark, folder)
    fact = star.fact_sales(lines, *(f(lines) for f in (star.dim_customer, star.dim_product, star.dim_region, star.dim_ship_mode)))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        fact.explain()
    plan = out.getvalue()  # the last join is the first line of the plan
    assert plan.index("[product_id") < plan.index("[customer_id") < plan.index("[ship_mode")
    assert fact.count() == lines.count()


def test_repeated_rows_among_nulls(spark):
    rows = [(1, "a", None), (1, "a", None), (1, None, 0.0), (1, None, -0.0), (2, "b", 1.0), (None, None, None), (1, "a", 1.0)]
    df = spark.createDataFrame(rows, "k long, s string, x double")
    found = {r.measure: r.rows for r in profiling.profile_duplicates(df, ("k", "s"), ("k",)).collect()}
    assert found == {"duplicate_rows": 2, "duplicate_k_s": 3, "distinct_k": 2}
    assert all("/profiled-" in f or "/repeated-hashes-" in f for f in profiling.profile_duplicates(df, ("k", "s"), ("k",)).inputFiles())
    none = profiling.profile_duplicates(df.limit(0), ("k", "s"), ("k",))
    assert {r.measure: r.rows for r in none.collect()} == {"duplicate_rows": 0, "duplicate_k_s": 0}
