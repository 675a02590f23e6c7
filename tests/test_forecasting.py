"""Series, models, errors and the forecast marts."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.functions.expressions import mape, rmse
from tallymill.operators import forecasting, marts


def series_of(spark, **values):
    rows = []
    for name, ys in values.items():
        for i, y in enumerate(ys):
            rows.append((name, dt.date(2020 + i // 12, i % 12 + 1, 1), float(y)))
    return spark.createDataFrame(rows, "series_id string, month date, y double")


def test_moving_average_of_the_ramp(spark):
    out = forecasting.forecast_moving_average(series_of(spark, a=range(24)), 6, 3).collect()
    assert [r["yhat"] for r in out] == [22.0] * 6
    assert sorted(r["forecast_month"] for r in out)[0] == dt.date(2022, 1, 1)


def test_naive_repeats_the_last_value(spark):
    out = forecasting.forecast_naive(series_of(spark, a=range(5), b=[3]), 2)
    got = {(r["series_id"], r["forecast_month"].month, r["yhat"]) for r in out.collect()}
    assert got == {("a", 6, 4.0), ("a", 7, 4.0), ("b", 2, 3.0), ("b", 3, 3.0)}


def test_short_series_have_no_moving_average(spark):
    out = forecasting.forecast_moving_average(series_of(spark, a=[1, 2], b=[1, 2, 3]), 1, 3)
    assert [(r["series_id"], r["yhat"]) for r in out.collect()] == [("b", 2.0)]


def test_gaps_are_filled_with_zero(spark):
    lines = spark.createDataFrame(
        [(dt.date(2024, 1, 5), 1.5), (dt.date(2024, 4, 2), 2.0)], "order_date date, sales double"
    ).withColumn("sales", F.col("sales").cast("decimal(12,4)"))
    rows = forecasting.monthly_series(lines).orderBy("month").collect()
    assert [(r["month"].month, r["y"]) for r in rows] == [(1, 1.5), (2, 0.0), (3, 0.0), (4, 2.0)]


def test_holt_winters_is_exact_on_trend_and_season():
    t = np.arange(60)
    season = np.array([5, -3, 2, 8, -6, 1, 0, 4, -2, -4, 3, -8], dtype=float)
    y = 100 + 2.5 * t + season[t % 12]
    future, spread = forecasting.smooth(y, 6)
    ahead = np.arange(60, 66)
    assert future == pytest.approx(100 + 2.5 * ahead + season[ahead % 12], abs=1e-6)
    assert spread == pytest.approx(0, abs=1e-6)


def test_short_series_get_a_trend_only():
    future, _ = forecasting.smooth(np.arange(10, dtype=float) * 3 + 1, 3)
    assert future == pytest.approx([31, 34, 37])


def test_ets_runs_per_series(spark):
    out = forecasting.forecast_ets(series_of(spark, a=range(30), b=range(30, 0, -1)), 4)
    last = {r["series_id"]: r["yhat"] for r in out.orderBy("forecast_month").collect()}
    assert last["a"] == pytest.approx(33, abs=1e-6)
    assert last["b"] == 0.0  # the falling line would be negative


def test_boosting_stays_within_what_it_saw(spark):
    wave = [100 + 10 * np.sin(i * np.pi / 6) for i in range(60)]
    out = forecasting.forecast_gbt(series_of(spark, a=wave, b=[1, 2, 3]), 6, trees=15, step=0.3)
    rows = out.orderBy("forecast_month").collect()
    assert {r["series_id"] for r in rows} == {"a"} and len(rows) == 6
    assert all(85 < r["yhat"] < 115 and r["yhat_lower"] <= r["yhat"] for r in rows)
    truth = [100 + 10 * np.sin(i * np.pi / 6) for i in range(60, 66)]
    assert [r["yhat"] for r in rows] == pytest.approx(truth, abs=4)


def test_features_match_the_recursive_step(spark):
    """The array form of the next month's features equals the window form."""
    ys = [float((i * 7) % 11) for i in range(30)]
    whole = forecasting.forecast_features(series_of(spark, a=ys)).orderBy("month").collect()[-1]
    history = spark.createDataFrame([(ys[-13:-1], dt.date(2022, 6, 1))], "h array<double>, m date")
    row = history.select(*forecasting._next_features(F.col("h"), F.col("m"))).first()
    assert [row[c] for c in forecasting.FEATURES] == pytest.approx(
        [whole[c] for c in forecasting.FEATURES])


def test_errors(spark):
    pairs = spark.createDataFrame([(100.0, 110.0), (200.0, 180.0), (0.0, 5.0)], "y double, p double")
    row = pairs.agg(mape(F.col("y"), F.col("p")).alias("m"), rmse(F.col("y"), F.col("p")).alias("r"))
    assert tuple(row.first()) == pytest.approx((10.0, np.sqrt((100 + 400 + 25) / 3)))
    same = spark.createDataFrame([(1.0,), (2.0,)], "y double")
    assert tuple(same.agg(mape(F.col("y"), F.col("y")), rmse(F.col("y"), F.col("y"))).first()) == (0, 0)


BASELINES = {
    "naive": forecasting.forecast_naive, "baseline_ma": forecasting.forecast_moving_average,
}


def test_one_winner_per_series(spark):
    """Grouping a union of per-series forecasts gives one row per series."""
    series = series_of(spark, a=range(24), b=[5, 1, 3] * 8, c=[2] * 24)
    winners = forecasting.select_winner(forecasting.compare_models(series, BASELINES))
    rows = {r["series_id"]: r["winning_model"] for r in winners.collect()}
    assert winners.count() == 3
    assert rows == {"a": "naive", "b": "baseline_ma", "c": "baseline_ma"}


def test_sales_forecast_marks_one_winner_per_month(spark):
    series = series_of(spark, a=range(24), b=[5, 1, 3] * 8)
    out = forecasting.sales_forecast(series, BASELINES)
    assert out.count() == 24 and out.filter("is_winner").count() == 12


def test_missing_bounds_become_fifteen_percent(spark):
    month = dt.date(2024, 1, 1)
    rows = [
        (month, "ets", 100.0, float("nan"), None, True),
        (month, "gbt", 90.0, 80.0, 99.0, False),
        (dt.date(2024, 2, 1), "gbt", 10.0, 8.0, 13.5, False),
    ]
    df = spark.createDataFrame(
        rows, "forecast_month date, model_name string, yhat double, yhat_lower double,"
        " yhat_upper double, is_winner boolean")
    out = [tuple(r)[1:] for r in marts.forecast_performance(df).orderBy("forecast_month").collect()]
    assert out == [("ets", 100.0, 85.0, 115.0, 15.0, 15.0), ("gbt", 10.0, 8.0, 13.5, 2.0, 3.5)]
