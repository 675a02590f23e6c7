"""KPIs, marts, checks, profiles, health and tables on edge cases."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymill.functions.expressions import SEGMENTS, segment_label
from tallymill.operators import health, kpis, marts, profiling, quality, sales
from tallymill.plans.batch import build_forecasts, build_warehouse, verify_warehouse
from tallymill.plans.registry import Source
from tallymill.session import scratch_path, stored
from tallymill.sources import publish, tables


def test_every_score_has_one_known_label(spark):
    scores = spark.range(125).selectExpr(
        "cast(id div 25 + 1 AS int) AS r_score", "cast(id div 5 % 5 + 1 AS int) AS f_score",
        "cast(id % 5 + 1 AS int) AS m_score")
    labels = {tuple(r)[:3]: r[3] for r in scores.withColumn("l", segment_label()).collect()}
    assert set(labels.values()) == set(SEGMENTS)
    assert labels[5, 5, 5] == "Champions" and labels[3, 4, 3] == "Loyal Customers"
    assert labels[4, 2, 2] == "Potential Loyalists" and labels[2, 3, 3] == "At Risk"
    assert labels[1, 1, 2] == "Lost" and labels[5, 1, 5] == "New Customers"
    assert labels[3, 3, 3] == "Need Attention"


def monthly(spark, *rows):
    full = [(y, m, "Jan", float(r), float(p), 1, 1.0) for y, m, r, p in rows]
    return spark.createDataFrame(
        full, "year int, month int, month_name string, revenue double, profit double,"
        " orders bigint, avg_line_value double")


def test_zero_totals_give_null_ratios(spark):
    rows = marts.executive_kpis(monthly(spark, (2023, 1, 0, 0), (2024, 1, 50, 5), (2024, 2, 50, 0)))
    got = {r["year"]: r for r in rows.collect()}
    assert got[2023]["profit_margin_pct"] is None and got[2023]["revenue_to_profit"] is None
    assert got[2024]["yoy_growth_pct"] is None and got[2024]["prev_year_revenue"] == 0
    assert (got[2024]["profit_margin_pct"], got[2024]["revenue_to_profit"]) == (5.0, 20.0)
    assert got[2024]["months_reported"] == 2


def test_growth(spark):
    rows = kpis.month_over_month(monthly(spark, (2024, 2, 150, 0), (2024, 1, 100, 0))).collect()
    assert {r["month"]: r["mom_growth_pct"] for r in rows} == {1: None, 2: 50.0}


def test_constant_discount_has_no_slope(spark):
    rows = [("a", "0.07", 1, 1), ("a", "0.07", 3, 1), ("a", "0.07", 3, 1),
            ("b", "0.1", 1, 10), ("b", "0.2", 2, 5)]
    df = spark.createDataFrame(
        [(p, Decimal(d), q, Decimal(x)) for p, d, q, x in rows],
        "product_id string, discount decimal(5,4), quantity bigint, profit decimal(12,4)")
    got = {r["product_id"]: tuple(r)[2:] for r in kpis.discount_sensitivity(df).collect()}
    assert got == {"a": (None, None, None), "b": (1.0, 10.0, -50.0)}


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None, Decimal(1)), ("x", Decimal(2))], "d string, sales decimal(12,4)")
    assert {tuple(r) for r in sales.revenue_by(df, "d").collect()} == {(None, 1.0), ("x", 2.0)}


def test_row_rules_find_failures(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (7, "c")], "n int, s string")
    found = quality.check_rows(
        df, "t", *quality.not_null("n"), *quality.accepted_values("s", ["a", "b"]),
        *quality.value_range("n", 1, 5), *quality.expression_true("n < 9"))
    assert [(r["check_name"], r["failures"], r["passed"]) for r in found.collect()] == [
        ("not_null", 1, False), ("accepted_values", 1, False), ("range", 1, False),
        ("expression_true", 0, True)]


def test_unique_and_parity(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert quality.unique(df, "t", "k").first()["failures"] == 1
    assert quality.row_count_parity(df, df.limit(1), "t").first()["failures"] == 3
    assert quality.measure_parity(df, df, "t", "k").first()["passed"]
    assert not quality.measure_parity(df, df.filter("k = 2"), "t", "k").first()["passed"]
    assert not quality.row_bounds(df, "t", 5).first()["passed"]
    assert quality.row_bounds(df, "t", 2, 2, "k").first()["passed"]
    empty = df.filter("k = 99")
    assert quality.unique(empty, "t", "k").first()["passed"]


def test_profile_of_odd_dates_and_constants(spark):
    df = spark.createDataFrame([("2024-01-01", 1.0), ("2024-01-03", 1.0), ("soon", 1.0), (None, None)],
                               "d string, v double")
    assert tuple(profiling.profile_dates(df, "d").first())[3:] == (2, 2)
    assert [tuple(r) for r in profiling.histogram(df, "v").collect()] == [("v", 1, 3)]
    profile = {r["column_name"]: tuple(r)[2:] for r in profiling.profile_columns(df).collect()}
    assert profile == {"d": (3, 1, 25.0, 3), "v": (3, 1, 25.0, 1)}


def test_alerts(spark):
    at = dt.datetime(2024, 1, 1, 12)
    rows = [
        ("table_rows", "fact", at - dt.timedelta(hours=3), 9000.0),
        ("table_rows", "fact", at - dt.timedelta(minutes=50), 5000.0),
        ("table_rows", "fact", at, 3500.0),
        ("freshness_seconds", "", at, 90_000.0),
        ("winner_mape", "total", at, 51.0),
    ]
    df = spark.createDataFrame(rows, "metric string, label string, observed_at timestamp, value double")
    got = {r["alert"]: (r["change"], r["firing"]) for r in health.health_alerts(df).collect()}
    assert got == {"data_stale": (0, False), "rows_dropping": (-1500, True),
                   "forecast_error_high": (0, True)}


def test_headers_and_typed_staging(spark):
    raw = spark.createDataFrame(
        [(" 7 ", "2024-02-30", "", "1.23456"), ("x", "2024-02-03", "5", "")],
        ["Linha ID", " Data-Ordem ", "Código", "VENDAS"])
    clean = tables.normalize_columns(raw)
    assert clean.columns == ["row_id", "order_date", "código", "sales"]
    rows = [tuple(r) for r in tables.stage_typed(clean).collect()]
    assert rows == [(7, None, Decimal("1.2346")), (None, dt.date(2024, 2, 3), None)]
    verdict = tables.validate_columns(clean, ["row_id", "profit"]).first()
    assert tuple(verdict) == ("profit", False, 2, False)


def test_ingest_append_counts_only_its_own_rows(spark, folder):
    raw, path = tables.scan_parquet(spark, f"{folder}/nation.parquet"), scratch_path(spark, "in")
    tables.ingest_bronze(spark, raw, path, ["n_regionkey"])
    table = tables.ingest_bronze(spark, raw, path, ["n_regionkey"], mode="append")
    assert table.count() == 50
    assert {r["_layer"] for r in table.select("_layer").distinct().collect()} == {"bronze"}
    assert table.filter("_source_file LIKE '%nation.parquet'").count() == 50


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "v double, k int")
    assert [r["v"] for r in tables.missing_to_null(df).orderBy("k").collect()] == [None, 2.0]


def test_publishing(spark):
    root = scratch_path(spark, "out")
    df = monthly(spark, (2024, 2, 1, 1), (2023, 1, 1, 1))
    names = publish.publish_catalog(
        {"monthly_revenue": df, "unknown": df}, publish.file_sink(root))
    assert names == ["monthly_revenue"]
    assert publish.published_counts(spark, root, names).first()["rows"] == 2
    assert publish.sort_for_publish(df, ["year", "none"]).first()["year"] == 2023
    options = publish.jdbc_options("jdbc:x", "s.t", user="u")
    assert options == {"url": "jdbc:x", "dbtable": "s.t", "user": "u"}


def test_warehouse_verifies(spark, folder):
    source = Source(spark, folder)
    root = scratch_path(spark, "warehouse")
    built = build_warehouse(spark, stored(source.lines(), "raw"), root, top_n=10)
    assert verify_warehouse(built).filter("NOT passed").isEmpty()
    assert built["top_products"].count() == 10
    assert built["mart_customer_intelligence"].agg(F.sum("customers")).first()[0] == \
        built["customer_rfm"].count()


def test_forecast_build(spark, folder):
    from tallymill.operators import forecasting
    models = {k: forecasting.MODELS[k] for k in ("baseline_ma", "ets")}
    root = scratch_path(spark, "forecasts")
    lines = Source(spark, folder).lines("order_date", "sales")
    built = build_forecasts(spark, lines, root, models=models)
    forecast, mart = built["sales_forecast"], built["mart_forecast_performance"]
    assert forecast.count() == 12 and mart.count() == 6
    checks = quality.report(
        quality.one_winner_per_month(forecast, "sales_forecast", "series_id"),
        quality.check_rows(
            mart, "mart", *quality.expression_true("yhat_upper >= forecast_revenue"),
            *quality.expression_true("forecast_revenue >= yhat_lower"),
            *quality.value_range("forecast_revenue", above=0)))
    assert checks.filter("NOT passed").isEmpty()


@pytest.mark.parametrize("limit", [1, 2])
def test_chart_limit(spark, limit):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("a", 4.0)], "d string, revenue double")
    rows = sales.chart_series(df, "d", "revenue", limit).collect()
    assert [tuple(r) for r in rows] == [("a", 5.0), ("b", 3.0)][:limit]


def test_a_customer_with_two_names_keeps_all_sales(spark):
    from tallymill.operators import customers

    rows = [("c1", "Ann", "Home", 1, 10), ("c1", "Anne", "Home", 2, 20), ("c2", "Bo", "Home", 3, 5)]
    lines = spark.createDataFrame(rows, "customer_id string, customer_name string, segment string, order_id int, sales int") \
        .withColumn("order_date", F.make_date(F.lit(2024), F.lit(1), F.col("order_id"))).withColumn("sales", F.col("sales").cast("decimal(12,2)"))
    scored = {r.customer_id: r for r in customers.customer_rfm(lines).collect()}
    assert {c: r.monetary for c, r in scored.items()} == {"c1": 30.0, "c2": 5.0}
    assert scored["c1"].customer_name == "Ann" and scored["c1"].frequency == 2 and scored["c1"].recency_days == 1


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")


def test_numeric_profile_from_counts(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, None), (4.0, None), (None, None)], "a double, b double")
    got = {r["column_name"]: r.asDict() for r in profiling.profile_numeric(df, "a", "b").collect()}
    assert (got["a"]["rows"], got["a"]["mean"], got["a"]["std"], got["a"]["min"], got["a"]["max"]) == (3, 2.0, 1.7321, 1.0, 4.0)
    assert (got["b"]["rows"], got["b"]["mean"], got["b"]["std"], got["b"]["median"]) == (1, 5.0, None, 5.0)
