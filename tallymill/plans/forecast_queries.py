"""Queries on monthly series and forecasts, one series per category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.operators import forecasting, marts, quality
from tallymill.plans.registry import Source, query
from tallymill.session import stored

BASELINES = {
    "naive": forecasting.forecast_naive,
    "baseline_ma": forecasting.forecast_moving_average,
}
# the models that SQL can fit again; the smoothing has bounds of its own
CHECKED = {**BASELINES, "ets": forecasting.forecast_ets}
FITTED = forecasting.MODELS


def series(s: Source) -> DataFrame:
    return forecasting.monthly_series(
        s.lines("category", "order_date", "sales"), F.col("category")
    )


def stored_series(s: Source) -> DataFrame:
    """The series as a small written table, for what reads it many times."""
    return stored(series(s), "series")


def forecast(s: Source) -> DataFrame:
    return forecasting.sales_forecast(series(s), CHECKED)


def forecast_vs_actual(monthly: DataFrame) -> DataFrame:
    return marts.forecast_vs_actual(monthly, forecasting.sales_forecast(monthly, CHECKED))


def comparison(s: Source) -> DataFrame:
    return forecasting.compare_models(stored_series(s), CHECKED)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


def to_cents(forecasts: DataFrame) -> DataFrame:
    return forecasts.withColumns({c: F.round(c, 2) for c in ("yhat", "yhat_lower", "yhat_upper")})


query("monthly_series", "SELECT * FROM series_sql")(series)
query("forecast_naive", "SELECT * FROM baseline_sql WHERE model_name = 'naive'")(
    lambda s: forecasting.forecast_naive(series(s)))
query("forecast_baseline_ma", """
    SELECT series_id, forecast_month, model_name, round(yhat, 4) AS yhat, yhat_lower, yhat_upper
    FROM baseline_sql WHERE model_name = 'baseline_ma'
""")(lambda s: rounded(forecasting.forecast_moving_average(series(s)), "yhat"))
query("union_model_outputs", """
    SELECT series_id, forecast_month, model_name, round(yhat, 2) AS yhat,
        round(yhat_lower, 2) AS yhat_lower, round(yhat_upper, 2) AS yhat_upper
    FROM models_sql
""")(lambda s: to_cents(forecasting.union_models(stored_series(s), CHECKED)))

FEATURES_SQL = """
    SELECT series_id, month,
        lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 3) OVER w AS lag_3,
        lag(y, 12) OVER w AS lag_12,
        round(avg(y) OVER (PARTITION BY series_id ORDER BY month
            ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 4) AS roll_3,
        round(avg(y) OVER (PARTITION BY series_id ORDER BY month
            ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING), 4) AS roll_6,
        round(avg(y) OVER (PARTITION BY series_id ORDER BY month
            ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING), 4) AS roll_12,
        y, cast(month(month) AS int) AS month_of_year, cast(quarter(month) AS int) AS quarter,
        cast(year(month) AS int) AS year
    FROM series_sql WINDOW w AS (PARTITION BY series_id ORDER BY month)
"""
FEATURE_ROWS = f"FROM ({FEATURES_SQL}) WHERE lag_12 IS NOT NULL"


def features(s: Source) -> DataFrame:
    return rounded(forecasting.forecast_features(series(s)), "roll_3", "roll_6", "roll_12")


query("forecast_features", f"SELECT * {FEATURE_ROWS}")(features)
query("lag_features", f"SELECT series_id, month, lag_1, lag_2, lag_3, lag_12 {FEATURE_ROWS}")(
    lambda s: features(s).select("series_id", "month", "lag_1", "lag_2", "lag_3", "lag_12"))
query("rolling_mean_features", f"SELECT series_id, month, roll_3, roll_6, roll_12 {FEATURE_ROWS}")(
    lambda s: features(s).select("series_id", "month", "roll_3", "roll_6", "roll_12"))

query("mape", "SELECT series_id, model_name, round(mape, 4) AS mape FROM errors_sql")(
    lambda s: rounded(comparison(s), "mape").drop("rmse"))
query("rmse", "SELECT series_id, model_name, round(rmse, 4) AS rmse FROM errors_sql")(
    lambda s: rounded(comparison(s), "rmse").drop("mape"))
query("compare_baselines", """
    SELECT series_id, model_name, round(mape, 4) AS mape, round(rmse, 4) AS rmse FROM errors_sql
""")(lambda s: rounded(comparison(s), "mape", "rmse"))
query("select_winner", "SELECT * FROM winner_sql")(
    lambda s: forecasting.select_winner(comparison(s)))

query("sales_forecast_baselines", "SELECT * FROM forecast_sql")(forecast)
query("filter_winner", "SELECT * FROM forecast_sql WHERE is_winner ORDER BY forecast_month")(
    lambda s: forecast(s).filter("is_winner").orderBy("forecast_month"))
query("forecast_all_models", "SELECT * FROM forecast_sql ORDER BY model_name, forecast_month")(
    lambda s: forecast(s).orderBy("model_name", "forecast_month"))
query("first_per_group", """
    SELECT series_id, forecast_month, model_name FROM (
        SELECT *, row_number() OVER (PARTITION BY series_id, forecast_month
            ORDER BY is_winner DESC, model_name) AS place FROM forecast_sql) WHERE place = 1
""")(lambda s: marts.winner_per_month(forecast(s), "series_id")
     .select("series_id", "forecast_month", "model_name"))
query("stg_sales_forecast", """
    SELECT forecast_month, model_name, yhat, yhat_lower, yhat_upper, is_winner FROM forecast_sql
""")(lambda s: marts.stage(forecast(s), "sales_forecast")
     .withColumn("yhat", F.col("yhat").cast("double")))
PERFORMANCE_SQL = """
    SELECT series_id, forecast_month, model_name AS winning_model,
        cast(y AS double) AS forecast_revenue,
        cast(round(lo, 2) AS double) AS yhat_lower, cast(round(hi, 2) AS double) AS yhat_upper,
        cast(round(y - lo, 2) AS double) AS lower_uncertainty,
        cast(round(hi - y, 2) AS double) AS upper_uncertainty
    FROM (SELECT series_id, forecast_month, model_name, cast(yhat AS decimal(18,2)) AS y,
              coalesce(cast(yhat_lower AS decimal(18,2)), cast(yhat AS decimal(18,2)) * 0.85) AS lo,
              coalesce(cast(yhat_upper AS decimal(18,2)), cast(yhat AS decimal(18,2)) * 1.15) AS hi
          FROM forecast_sql WHERE is_winner)
"""
query("mart_forecast_performance", PERFORMANCE_SQL)(lambda s: marts.forecast_performance(forecast(s), "series_id"))
query("forecast_vs_actual", """
    SELECT series_id, month, 'actual' AS series, y FROM series_sql
    UNION ALL
    SELECT series_id, forecast_month, model_name, yhat FROM forecast_sql WHERE is_winner
""")(lambda s: forecast_vs_actual(stored_series(s)))
query("dq_one_winner_per_month", """
    SELECT 'one_winner_per_month' AS check_name, 'sales_forecast' AS table_name,
        'is_winner' AS column_name, count(*) FILTER (w <> 1) AS failures,
        count(*) FILTER (w <> 1) = 0 AS passed
    FROM (SELECT count(*) FILTER (is_winner) AS w FROM forecast_sql
          GROUP BY series_id, forecast_month)
""")(lambda s: quality.one_winner_per_month(forecast(s), "sales_forecast", "series_id"))

query("forecast_ets", """
    SELECT series_id, forecast_month, model_name, round(yhat, 2) AS yhat,
        round(yhat_lower, 2) AS yhat_lower, round(yhat_upper, 2) AS yhat_upper FROM ets_sql
""")(lambda s: to_cents(forecasting.forecast_ets(series(s))))
query("ets_parameters", """
    SELECT series_id, n AS months, round(alpha, 6) AS alpha, round(beta, 6) AS beta,
        round(gamma, 6) AS gamma, round(start, 2) AS start, round(slope, 2) AS slope,
        round(level, 2) AS level, round(trend, 2) AS trend, round(spread, 2) AS spread FROM ets_fit
""")(lambda s: forecasting.ets_parameters(series(s)).select(
    "series_id", "months", *(F.round(c, 6).alias(c) for c in ("alpha", "beta", "gamma")),
    *(F.round(c, 2).alias(c) for c in ("start", "slope", "level", "trend", "spread"))))

# Boosted trees have no SQL counterpart; tests check them on known series.
query("forecast_gbt")(lambda s: FITTED["gbt"](stored_series(s)))
query("compare_models")(lambda s: forecasting.compare_models(stored_series(s), FITTED))
query("sales_forecast")(lambda s: forecasting.sales_forecast(series(s), FITTED))
