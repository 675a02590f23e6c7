"""Health metrics of the built tables, and alerts on their history."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.expressions import age_seconds
from tallymill.functions.unions import union_rows


def _metric(df: DataFrame, metric: str, label: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(metric).alias("metric"), label.cast("string").alias("label"),
        value.cast("double").alias("value"),
    )


def row_count_metrics(tables: Mapping[str, DataFrame]) -> DataFrame:
    counted = (
        _metric(df.agg(F.count(F.lit(1)).alias("n")), "table_rows", F.lit(name), F.col("n"))
        for name, df in tables.items()
    )
    return union_rows(counted)


def freshness_metric(df: DataFrame, moment: str, as_of: Column) -> DataFrame:
    last = df.agg(F.max(moment).alias("last"))
    return _metric(last, "freshness_seconds", F.lit(""), age_seconds(as_of, F.col("last")))


def winner_mape_metric(comparison: DataFrame) -> DataFrame:
    """The holdout error of the winning model, per series."""
    best = comparison.groupBy("series_id").agg(F.min("mape").alias("mape"))
    return _metric(best, "winner_mape", F.col("series_id"), F.col("mape"))


def segment_size_metrics(segments: DataFrame) -> DataFrame:
    sizes = segments.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("n"))
    return _metric(sizes, "segment_size", F.col("cluster_label"), F.col("n"))


def manifest_metrics(manifest: DataFrame, as_of: Column, dated: str = "sales_forecast") -> DataFrame:
    """Row counts of the served tables, and the age of one, as publishing recorded them."""
    age = age_seconds(as_of, F.date_trunc("second", "computed_at"))
    return union_rows([
        _metric(manifest, "table_rows", F.col("table_name"), F.col("rows")),
        _metric(manifest.filter(F.col("table_name") == dated), "freshness_seconds", F.lit(""), age),
    ])


def health_metrics(
    tables: Mapping[str, DataFrame],
    manifest: DataFrame,
    as_of: Column,
    comparison: DataFrame,
    segments: DataFrame,
) -> DataFrame:
    """Row counts, freshness, winner error and segment sizes as (metric, label, value).

    The served tables are counted by their manifest; ``tables`` are further ones to count.
    """
    return union_rows([
        row_count_metrics(tables),
        manifest_metrics(manifest, as_of),
        winner_mape_metric(comparison),
        segment_size_metrics(segments),
    ])


@dataclass(frozen=True)
class Alert:
    """Fires when the value, or its change in a window, has passed the limit for ``hold_seconds``."""

    name: str
    severity: str
    metric: str
    above: float | None = None
    change_below: float | None = None
    window_seconds: int = 3600
    hold_seconds: int = 0


# The alert limits and hold times.
ALERTS = (
    Alert("data_stale", "warning", "freshness_seconds", above=90_000, hold_seconds=300),
    Alert("rows_dropping", "critical", "table_rows", change_below=-1_000, hold_seconds=600),
    Alert("forecast_error_high", "warning", "winner_mape", above=50, hold_seconds=1_800),
)


def health_alerts(history: DataFrame, alerts: tuple[Alert, ...] = ALERTS) -> DataFrame:
    """Alerts over a history of (metric, label, observed_at, value).

    Each series is judged at its own last observation; the change is taken
    over the alert's window up to then. Only aggregates, so a long history
    shuffles one partial row per series and task.
    """
    series = ["metric", "label"]
    ends = history.groupBy(*series).agg(
        F.max("observed_at").alias("last_at"),
        F.max_by("value", "observed_at").alias("last_value"),
    )
    recent = history.join(ends, series)
    judged = []
    for alert in alerts:
        age = age_seconds(F.col("last_at"), F.col("observed_at"))
        window = recent.filter((F.col("metric") == alert.metric) & (age <= alert.window_seconds))
        state = window.groupBy(*series).agg(
            F.first("last_value").alias("last_value"),
            (F.first("last_value") - F.min_by("value", "observed_at")).alias("change"),
        )
        firing = (F.col("last_value") > alert.above if alert.above is not None
                  else F.col("change") < alert.change_below)
        judged.append(state.select(
            F.lit(alert.name).alias("alert"), F.lit(alert.severity).alias("severity"),
            *series, "last_value", F.round("change", 4).alias("change"), firing.alias("firing"),
        ))
    return union_rows(judged)


def alert_episodes(history: DataFrame, alerts: tuple[Alert, ...] = ALERTS) -> DataFrame:
    """Every stretch of observations over an alert's limit, with the state it came to.

    ``history`` holds (metric, label, observed_at, value), one row per series and
    moment. A stretch is pending from ``started_at`` and firing from the first
    observation at least the hold time later (``firing_at``); the first
    observation back within the limit ends it (``ended_at``). States: pending,
    firing, resolved (fired, then ended), lapsed (ended before it fired). NULL
    values are no observations. A series is sorted within its own partition.
    """
    series = ["metric", "label"]
    in_time = Window.partitionBy(*series).orderBy("_at")
    seen = history.filter(F.col("value").isNotNull()).withColumn("_at", F.unix_micros("observed_at"))
    found = []
    for alert in alerts:
        own = seen.filter(F.col("metric") == alert.metric)
        before = F.first("value").over(in_time.rangeBetween(-alert.window_seconds * 1_000_000, 0))
        over = (F.col("value") > alert.above if alert.above is not None
                else F.col("value") - before < alert.change_below)
        marked = own.withColumn("_over", over).withColumns({
            "_next": F.lead("observed_at").over(in_time),
            "_begins": (F.col("_over") & ~F.coalesce(F.lag("_over").over(in_time), F.lit(False))).cast("int"),
        }).withColumn("_stretch", F.sum("_begins").over(in_time)).filter("_over")
        held = F.col("_at") >= F.min("_at").over(Window.partitionBy(*series, "_stretch")) + alert.hold_seconds * 1_000_000
        stretches = marked.withColumn("_held", held).groupBy(*series, "_stretch").agg(
            F.min("observed_at").alias("started_at"),
            F.min(F.when(F.col("_held"), F.col("observed_at"))).alias("firing_at"),
            F.max_by("_next", "_at").alias("ended_at"),
            F.max_by("value", "_at").alias("last_value"),
        )
        open_state = F.when(F.col("firing_at").isNull(), "pending").otherwise("firing")
        closed_state = F.when(F.col("firing_at").isNull(), "lapsed").otherwise("resolved")
        found.append(stretches.select(
            F.lit(alert.name).alias("alert"), F.lit(alert.severity).alias("severity"), *series,
            "started_at", "firing_at", "ended_at", "last_value",
            F.when(F.col("ended_at").isNull(), open_state).otherwise(closed_state).alias("state"),
        ))
    return union_rows(found)


def alert_states(episodes: DataFrame, as_of: Column) -> DataFrame:
    """What each alert says at a moment: the stretches begun by then and not yet over."""
    begun = episodes.filter((F.col("started_at") <= as_of) & (F.col("ended_at").isNull() | (F.col("ended_at") > as_of)))
    firing = F.col("firing_at").isNotNull() & (F.col("firing_at") <= as_of)
    return begun.select(
        "alert", "severity", "metric", "label", "started_at",
        F.when(firing, "firing").otherwise("pending").alias("state"),
    )
