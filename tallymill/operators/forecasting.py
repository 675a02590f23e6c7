"""Monthly forecasts for many series at once.

A series is first reduced to one row per month, so whatever is grouped by
series afterwards is as long as the calendar, not as the data.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tallymill.functions.expressions import cents, mape, month_start, rmse
from tallymill.functions.unions import union_rows
from tallymill.session import stored

# ship this module's functions with the job, so workers need no install of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEASON = 12
GRIDS = (7, 5, 5)  # weights along each axis, in grids of a quarter of the width before
LAGS = (1, 2, 3, 12)
ROLLS = (3, 6, 12)
FEATURES = (
    *(f"lag_{k}" for k in LAGS), *(f"roll_{k}" for k in ROLLS),
    "month_of_year", "quarter", "year",
)
FORECAST = ("series_id", "forecast_month", "model_name", "yhat", "yhat_lower", "yhat_upper")
Model = Callable[[DataFrame, int], DataFrame]


def _whole_series() -> WindowSpec:
    return Window.partitionBy("series_id")


def _in_time() -> WindowSpec:
    return _whole_series().orderBy("month")


def monthly_series(lines: DataFrame, series: Column | None = None) -> DataFrame:
    """(series_id, month, y): revenue per month without gaps, empty months 0."""
    name = F.lit("total") if series is None else series.cast("string")
    sums = lines.groupBy(name.alias("series_id"), month_start("order_date").alias("month")).agg(
        cents(F.sum("sales")).alias("y")
    )
    until = F.coalesce(F.add_months(F.lead("month").over(_in_time()), -1), F.col("month"))
    spans = sums.withColumn("until", until).select(
        "series_id", "y", F.col("month").alias("seen"),
        F.explode(F.sequence("month", "until", F.expr("interval 1 month"))).alias("month"),
    )
    y = F.when(F.col("month") == F.col("seen"), F.col("y")).otherwise(F.lit(0.0))
    return spans.select("series_id", "month", y.alias("y"))


def _ahead(ends: DataFrame, horizon: int, model: str) -> DataFrame:
    """Repeat each (series_id, last, yhat) row over the months to come."""
    none = F.lit(None).cast("double")
    return ends.select(
        "series_id",
        F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "last", "yhat",
    ).select(
        "series_id",
        F.add_months("last", F.col("step")).alias("forecast_month"),
        F.lit(model).alias("model_name"),
        F.greatest("yhat", F.lit(0.0)).alias("yhat"),
        none.alias("yhat_lower"), none.alias("yhat_upper"),
    )


def forecast_naive(series: DataFrame, horizon: int = 6) -> DataFrame:
    """The last value repeated."""
    ends = series.groupBy("series_id").agg(
        F.max("month").alias("last"), F.max_by("y", "month").alias("yhat")
    )
    return _ahead(ends, horizon, "naive")


def forecast_moving_average(series: DataFrame, horizon: int = 6, window: int = 3) -> DataFrame:
    """The mean of the last ``window`` values repeated; shorter series give none."""
    recent = series.withColumn("last", F.max("month").over(_whole_series())).filter(
        F.col("month") > F.add_months("last", -window)
    )
    ends = recent.groupBy("series_id", "last").agg(
        F.avg("y").alias("yhat"), F.count(F.lit(1)).alias("n")
    ).filter(F.col("n") == window)
    return _ahead(ends, horizon, "baseline_ma")


@dataclass(frozen=True)
class Smoothing:
    """A fitted additive Holt-Winters model: weights, first and last state, errors' deviation."""

    alpha: float
    beta: float
    gamma: float
    start: float
    slope: float
    level: float
    trend: float
    season: np.ndarray  # the months to come, from the next one on
    spread: float

    def ahead(self, horizon: int) -> np.ndarray:
        h = np.arange(1, horizon + 1)
        return self.level + h * self.trend + self.season[(h - 1) % len(self.season)]


def fit_smoothing(y: np.ndarray) -> Smoothing:
    """Additive Holt-Winters, with a season from 24 values on.

    The smoothing weights are the best of a grid by squared error, then of a
    finer grid around that point, twice. All weights of a grid advance together.
    """
    n = len(y)
    seasonal = n >= 2 * SEASON
    steps = np.arange(1, SEASON + 1)
    if seasonal:
        first, second = y[:SEASON].mean(), y[SEASON:2 * SEASON].mean()
        slope = (second - first) / SEASON
        start = first - slope * (SEASON + 1) / 2
        pattern = y[:SEASON] - (start + slope * steps)
    else:
        slope = y[1] - y[0] if n > 1 else 0.0
        start = y[0] - slope
        pattern = np.zeros(1)

    def run(alpha, beta, gamma):
        level, trend = np.full(alpha.shape, start), np.full(alpha.shape, slope)
        season = np.tile(pattern[:, None], (1, alpha.size))
        errors = np.empty((n, alpha.size))
        for t, value in enumerate(y):
            at = t % len(pattern)
            expected = level + trend
            errors[t] = value - expected - season[at]
            raised = alpha * (value - season[at]) + (1 - alpha) * expected
            trend = beta * (raised - level) + (1 - beta) * trend
            if seasonal:
                season[at] = gamma * (value - expected) + (1 - gamma) * season[at]
            level = raised
        return level, trend, season, errors

    def grid(centre, width, count):
        axes = [np.clip(np.linspace(c - width, c + width, count), 0.0, 1.0) for c in centre]
        if not seasonal:
            axes[2] = np.zeros(1)
        return [axis.ravel() for axis in np.meshgrid(*axes, indexing="ij")]

    centre, width = (0.5, 0.5, 0.5), 0.5
    for count in GRIDS:
        weights = grid(centre, width, count)
        level, trend, season, errors = run(*weights)
        best = int(np.argmin((errors**2).sum(axis=0)))
        centre = tuple(float(axis[best]) for axis in weights)
        width /= 4
    spread = float(errors[:, best].std(ddof=1)) if n > 1 else float("nan")
    following = np.roll(season[:, best], -(n % len(pattern)))
    return Smoothing(*centre, float(start), float(slope), float(level[best]), float(trend[best]), following, spread)


def smooth(y: np.ndarray, horizon: int) -> tuple[np.ndarray, float]:
    """Forecasts and the deviation of one-step errors."""
    fit = fit_smoothing(y)
    return fit.ahead(horizon), fit.spread


def ets_parameters(series: DataFrame) -> DataFrame:
    """What ``forecast_ets`` fits to each series: weights, first state, last state, spread."""
    names = ("alpha", "beta", "gamma", "start", "slope", "level", "trend", "spread")

    def fit(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        fitted = fit_smoothing(frame.sort_values("month")["y"].to_numpy(dtype=float))
        return pd.DataFrame({"series_id": [key[0]], "months": [len(frame)], **{n: [getattr(fitted, n)] for n in names}})

    columns = ", ".join(f"{n} double" for n in names)
    return series.groupBy("series_id").applyInPandas(fit, f"series_id string, months long, {columns}")


def forecast_ets(series: DataFrame, horizon: int = 6) -> DataFrame:
    """Additive trend, and a 12-month season from 24 months on.

    The band is 1.96 deviations of the one-step errors either way.
    """
    def forecast(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("month")
        future, spread = smooth(frame["y"].to_numpy(dtype=float), horizon)
        last = pd.Timestamp(frame["month"].iloc[-1])
        return pd.DataFrame({
            "series_id": key[0],
            "forecast_month": [
                (last + pd.DateOffset(months=k)).date() for k in range(1, horizon + 1)
            ],
            "model_name": "ets",
            "yhat": np.maximum(future, 0.0),
            "yhat_lower": future - 1.96 * spread,
            "yhat_upper": future + 1.96 * spread,
        })

    return series.groupBy("series_id").applyInPandas(
        forecast,
        "series_id string, forecast_month date, model_name string,"
        " yhat double, yhat_lower double, yhat_upper double",
    )


def forecast_features(series: DataFrame) -> DataFrame:
    """Lags, means of the months before and calendar parts, where all exist."""
    full = {f"lag_{k}": F.lag("y", k).over(_in_time()) for k in LAGS}
    for k in ROLLS:
        full[f"roll_{k}"] = F.avg("y").over(_in_time().rowsBetween(-k, -1))
    full |= {
        "month_of_year": F.month("month"), "quarter": F.quarter("month"), "year": F.year("month"),
    }
    # twelve earlier months exist exactly where the longest lag does
    return series.withColumns(full).filter(F.col(f"lag_{max(LAGS)}").isNotNull()).select(
        "series_id", "month", "y", *FEATURES
    )


def _next_features(history: Column, month: Column) -> list[Column]:
    """The feature row of ``month`` from the array of the 12 values before it."""
    lags = [F.element_at(history, -k).alias(f"lag_{k}") for k in LAGS]
    rolls = [
        (F.aggregate(F.slice(history, -k, k), F.lit(0.0), lambda a, b: a + b) / k)
        .alias(f"roll_{k}")
        for k in ROLLS
    ]
    calendar = [
        F.month(month).alias("month_of_year"), F.quarter(month).alias("quarter"),
        F.year(month).alias("year"),
    ]
    return [*lags, *rolls, *calendar]


ROWS_PER_TASK = 100_000


def forecast_gbt(
    series: DataFrame,
    horizon: int = 6,
    trees: int = 300,
    depth: int = 3,
    step: float = 0.05,
    subsample: float = 0.9,
    columns: str = "0.9",
    seed: int = 42,
    least_rows: int = 12,
) -> DataFrame:
    """Boosted trees on lags, one model over all series, applied recursively.

    Each predicted month becomes a lag of the next. Series with fewer than
    ``least_rows`` feature rows give no forecast.
    """
    enough = F.count(F.lit(1)).over(_whole_series()) >= least_rows
    features = stored(
        forecast_features(series).withColumn("_enough", enough).filter("_enough").drop("_enough"),
        "features",
    )
    rows = features.count()
    if not rows:
        return features.sparkSession.createDataFrame(
            [], "series_id string, forecast_month date, model_name string,"
            " yhat double, yhat_lower double, yhat_upper double"
        )
    model = Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="_features"),
        GBTRegressor(
            featuresCol="_features", labelCol="y", predictionCol="_yhat", maxIter=trees,
            maxDepth=depth, stepSize=step, subsamplingRate=subsample, seed=seed,
            featureSubsetStrategy=columns,
        ),
    ]).fit(features.coalesce(1 + rows // ROWS_PER_TASK))  # a tree is several jobs: few tasks in each

    spread = model.transform(features).groupBy("series_id").agg(
        F.stddev_samp(F.col("y") - F.col("_yhat")).alias("spread")
    )
    latest = series.withColumn(
        "_back", F.row_number().over(_whole_series().orderBy(F.desc("month")))
    ).filter(F.col("_back") <= SEASON)
    state = (
        latest.groupBy("series_id").agg(
            F.max("month").alias("last"),
            F.sort_array(F.collect_list(F.struct("month", "y"))).getField("y").alias("history"),
        )
        .join(spread, "series_id")
        .withColumn("yhats", F.array().cast("array<double>"))
    )
    for _ in range(horizon):
        following = F.add_months("last", 1)
        rows = state.select("*", *_next_features(F.col("history"), following))
        predicted = F.greatest("_yhat", F.lit(0.0))
        state = model.transform(rows).select(
            "series_id", "spread",
            following.alias("last"),
            F.array_append(F.slice("history", 2, SEASON - 1), predicted).alias("history"),
            F.array_append("yhats", predicted).alias("yhats"),
        )
    months = state.select(
        "series_id", "spread", F.add_months("last", -horizon).alias("base"),
        F.posexplode("yhats").alias("step", "yhat"),
    )
    reach = 1.96 * F.col("spread")
    return months.select(
        "series_id",
        F.add_months("base", F.col("step") + 1).alias("forecast_month"),
        F.lit("gbt").alias("model_name"),
        "yhat",
        (F.col("yhat") - reach).alias("yhat_lower"),
        (F.col("yhat") + reach).alias("yhat_upper"),
    )


MODELS: Mapping[str, Model] = {
    "baseline_ma": forecast_moving_average,
    "ets": forecast_ets,
    "gbt": forecast_gbt,
}


def union_models(series: DataFrame, models: Mapping[str, Model], horizon: int = 6) -> DataFrame:
    return union_rows(model(series, horizon) for model in models.values())


def holdout_split(series: DataFrame, months: int = 6) -> tuple[DataFrame, DataFrame]:
    """All but the last ``months`` of each series, and those months."""
    marked = series.withColumn(
        "_held", F.col("month") > F.add_months(F.max("month").over(_whole_series()), -months)
    )
    return marked.filter("NOT _held").drop("_held"), marked.filter("_held").drop("_held")


def holdout_forecasts(
    series: DataFrame, models: Mapping[str, Model] = MODELS, holdout: int = 6
) -> DataFrame:
    """(series_id, model_name, month, y, yhat) over the months held out."""
    train, test = holdout_split(series, holdout)
    predicted = union_models(train, models, holdout).withColumnRenamed("forecast_month", "month")
    return test.join(predicted, ["series_id", "month"]).select(
        "series_id", "model_name", "month", "y", "yhat"
    )


def forecast_errors(pairs: DataFrame) -> DataFrame:
    y, yhat = F.col("y"), F.col("yhat")
    return pairs.groupBy("series_id", "model_name").agg(
        mape(y, yhat).alias("mape"), rmse(y, yhat).alias("rmse")
    )


def compare_models(
    series: DataFrame, models: Mapping[str, Model] = MODELS, holdout: int = 6
) -> DataFrame:
    """Holdout MAPE and RMSE per series and model; a model may give no row."""
    return forecast_errors(holdout_forecasts(series, models, holdout))


def select_winner(comparison: DataFrame) -> DataFrame:
    """The model with the lowest MAPE per series, ties by name."""
    best = F.min(F.struct(F.coalesce("mape", F.lit(float("inf"))), "model_name"))
    return comparison.groupBy("series_id").agg(
        best.getField("model_name").alias("winning_model")
    )


def sales_forecast(
    series: DataFrame,
    models: Mapping[str, Model] = MODELS,
    horizon: int = 6,
    holdout: int = 6,
) -> DataFrame:
    """Every model's forecast, with the holdout winner of each series marked."""
    series = stored(series, "series")
    winner = select_winner(compare_models(series, models, holdout))
    forecasts = union_models(series, models, horizon)
    won = F.coalesce(F.col("model_name") == F.col("winning_model"), F.lit(False))
    return forecasts.join(winner, "series_id", "left").select(
        "series_id", "forecast_month", "model_name",
        *(F.round(c, 2).alias(c) for c in ("yhat", "yhat_lower", "yhat_upper")),
        won.alias("is_winner"),
    )
