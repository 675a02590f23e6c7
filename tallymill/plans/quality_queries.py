"""Data-quality checks and health metrics over the source tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.expressions import SEGMENTS, age_seconds
from tallymill.functions.unions import union_rows
from tallymill.operators import customers, health, marts, quality, sales
from tallymill.plans import customer_queries, forecast_queries, sales_queries, star_queries
from tallymill.plans.registry import ORACLES, Source, query
from tallymill.sources import serving


def finding(check: str, table: str, column: str, failures: str, source: str) -> str:
    """The SQL of one check: ``failures`` is an aggregate over ``source``."""
    return (
        f"SELECT '{check}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,"
        f" cast({failures} AS bigint) AS failures, {failures} = 0 AS passed FROM {source}"
    )


# in the source tables: a join drops a missing key before it can be counted
CHECKED = {
    "lineitem": ("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity"),
    "orders": ("o_orderkey", "o_custkey", "o_orderdate"),
    "customer": ("c_custkey", "c_name", "c_nationkey"),
    "part": ("p_partkey", "p_type"),
}
query("dq_not_null", " UNION ALL ".join([
    *(finding("not_null", table, c, f"count(*) FILTER ({c} IS NULL)", table)
      for table, columns in CHECKED.items() for c in columns),
    finding("not_null", "lines", "postal_code", "count(*) FILTER (postal_code IS NULL)",
            "sales_lines"),
]))(lambda s: quality.report(
    *(quality.check_rows(s.table(table), table, *quality.not_null(*columns))
      for table, columns in CHECKED.items()),
    quality.check_rows(s.lines("postal_code"), "lines", *quality.not_null("postal_code")),
))

KEYS = {
    "lineitem": ("l_orderkey", "l_linenumber"), "orders": ("o_orderkey",),
    "customer": ("c_custkey",), "part": ("p_partkey",),
}
query("dq_unique", " UNION ALL ".join(
    finding("unique", table, ",".join(key), f"count(*) - count(DISTINCT ({', '.join(key)}))", table)
    for table, key in KEYS.items()
))(lambda s: quality.report(*(
    quality.unique(s.table(table), table, *key) for table, key in KEYS.items()
)))

query("dq_accepted_values", " UNION ALL ".join([
    finding("accepted_values", "segments", "cluster_label",
            "count(*) FILTER (cluster_label NOT IN ('Champions', 'Loyal Customers',"
            " 'Potential Loyalists', 'At Risk', 'Lost', 'New Customers', 'Need Attention'))",
            "segments"),
    finding("accepted_values", "lines", "ship_mode",
            "count(*) FILTER (ship_mode NOT IN ('1-URGENT', '2-HIGH'))", "sales_lines"),
]))(lambda s: quality.report(
    quality.check_rows(customer_queries.rfm(s), "segments",
                       *quality.accepted_values("cluster_label", SEGMENTS)),
    quality.check_rows(s.lines("ship_mode"), "lines",
                       *quality.accepted_values("ship_mode", ["1-URGENT", "2-HIGH"])),
))

RULES = (
    "revenue > 0", "profit / revenue BETWEEN -1 AND 1", "orders <= 20", "month BETWEEN 1 AND 12",
)
# The rules of the three marts.
MART_RULES = {
    "mart_executive_kpis": (
        "profit_margin_pct BETWEEN -100 AND 100", "months_reported BETWEEN 1 AND 12",
        "year_revenue > 0",
    ),
    "mart_customer_intelligence": (
        "customers > 0", "pct_of_customers BETWEEN 0 AND 100", "pct_of_revenue BETWEEN 0 AND 100",
        "round(pct_of_customers, 0) BETWEEN 0 AND 100",
    ),
    "mart_forecast_performance": (
        "forecast_revenue > 0", "yhat_upper >= forecast_revenue", "forecast_revenue >= yhat_lower",
    ),
}


@query("dq_expression_true", " UNION ALL ".join(
    finding("expression_true", table, r, f"count(*) FILTER (NOT ({r}))", source)
    for table, rules, source in [
        ("monthly_revenue", RULES, "months"),
        *((mart, rules, f"({ORACLES[mart]})") for mart, rules in MART_RULES.items()),
    ]
    for r in rules
))
def dq_expression_true(s: Source) -> DataFrame:
    monthly = sales_queries.monthly(s)
    built = {
        "monthly_revenue": (monthly, RULES),
        "mart_executive_kpis": (marts.executive_kpis(monthly),),
        "mart_customer_intelligence": (customers.customer_intelligence(customer_queries.rfm(s)),),
        "mart_forecast_performance": (
            marts.forecast_performance(forecast_queries.forecast(s), "series_id"),
        ),
    }
    return quality.report(*(
        quality.check_rows(df, table, *(
            rule for r in (*rules, *MART_RULES.get(table, ())) for rule in quality.expression_true(r)
        ))
        for table, (df, *own) in built.items() for rules in [own[0] if own else ()]
    ))

query("dq_range", " UNION ALL ".join([
    finding("range", "lines", "sales", "count(*) FILTER (sales < 0)", "sales_lines"),
    finding("range", "lines", "profit", "count(*) FILTER (profit <= 0)", "sales_lines"),
    finding("range", "lines", "quantity", "count(*) FILTER (quantity < 1 OR quantity > 40)",
            "sales_lines"),
]))(lambda s: quality.check_rows(
    s.lines("sales", "profit", "quantity"), "lines",
    *quality.value_range("sales", low=0), *quality.value_range("profit", above=0),
    *quality.value_range("quantity", 1, 40)))

query("dq_referential_integrity", " UNION ALL ".join([
    finding("referential_integrity", "orders", "o_custkey", "count(DISTINCT o_custkey)",
            "orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)"),
    finding("referential_integrity", "customer", "c_custkey", "count(DISTINCT c_custkey)",
            "customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"),
]))(lambda s: quality.report(
    quality.referential_integrity(
        s.table("orders"), "o_custkey", s.table("customer"), "orders", "c_custkey"),
    quality.referential_integrity(
        s.table("customer"), "c_custkey", s.table("orders"), "customer", "o_custkey"),
))

query("dq_row_count_parity", " UNION ALL ".join([
    finding("row_count_parity", "lines", "*",
            "abs((SELECT count(*) FROM sales_lines) - (SELECT count(*) FROM lineitem))",
            "(SELECT 1)"),
    finding("row_count_parity", "orders", "*",
            "abs((SELECT count(*) FROM orders) - (SELECT count(DISTINCT order_id)"
            " FROM sales_lines))", "(SELECT 1)"),
]))(lambda s: quality.report(
    quality.row_count_parity(s.lines("region", "category"), s.table("lineitem"), "lines"),
    quality.row_count_parity(s.table("orders"), s.lines("order_id").distinct(), "orders"),
))

query("dq_measure_parity", finding(
    "measure_parity", "monthly_revenue", "sales",
    "CASE WHEN abs((SELECT sum(sales) FROM sales_lines)"
    " - (SELECT sum(cast(revenue AS decimal(28,4))) FROM months)) > 5 THEN 1 ELSE 0 END",
    "(SELECT 1)",
))(lambda s: quality.measure_parity(
    s.lines("sales"), sales_queries.monthly(s).withColumnRenamed("revenue", "sales"),
    "monthly_revenue", "sales", 5.0))

query("dq_calendar_continuous", " UNION ALL ".join([
    finding("calendar_continuous", "dim_date", "full_date",
            "abs(date_diff('day', min(full_date), max(full_date)) + 1 - count(*))",
            "dim_date_sql"),
    finding("calendar_continuous", "orders", "order_date",
            "abs(date_diff('day', min(order_date), max(order_date)) + 1 - count(*))",
            "(SELECT DISTINCT order_date FROM sales_lines)"),
]))(lambda s: quality.report(
    quality.calendar_continuous(star_queries.calendar(s), "dim_date"),
    quality.calendar_continuous(s.lines("order_date").distinct(), "orders", "order_date"),
))

query("dq_weekend_flag", finding(
    "weekend_flag", "dim_date", "is_weekend",
    "count(*) FILTER (is_weekend <> (day_of_week IN (1, 7)))", "dim_date_sql",
))(lambda s: quality.check_rows(star_queries.calendar(s), "dim_date", *quality.weekend_flag()))

query("dq_row_bounds", " UNION ALL ".join([
    finding("row_bounds", "monthly_revenue", "*",
            "CASE WHEN count(*) BETWEEN 48 AND 144 THEN 0 ELSE 1 END", "months"),
    finding("row_bounds", "revenue_by_category", "category",
            "CASE WHEN count(DISTINCT category) BETWEEN 3 AND 3 THEN 0 ELSE 1 END", "categories"),
]))(lambda s: quality.report(
    quality.row_bounds(sales_queries.monthly(s), "monthly_revenue", 48, 144),
    quality.row_bounds(sales_queries.categories(s), "revenue_by_category", 3, 3, "category"),
))

query("dq_no_future_dates", finding(
    "no_future_dates", "lines", "order_date",
    "count(*) FILTER (order_date > DATE '2001-01-01')", "sales_lines",
))(lambda s: quality.check_rows(
    s.lines("order_date"), "lines",
    *quality.no_future_dates("order_date", dt.date(2001, 1, 1))))

query("dq_segment_ordering", finding(
    "segment_ordering", "customer_rfm", "recency_days",
    "CASE WHEN avg(recency_days) FILTER (cluster_label = 'Champions')"
    " >= avg(recency_days) FILTER (cluster_label = 'Lost') THEN 1 ELSE 0 END", "segments",
))(lambda s: quality.segment_ordering(customer_queries.rfm(s), "customer_rfm"))


PUBLISHED_AT, AS_OF = dt.datetime(2024, 1, 31, 23, 30), dt.datetime(2024, 2, 1)


@query("health_metrics", """
    SELECT 'table_rows' AS metric, 'fact_sales' AS label, cast(count(*) AS double) AS value
    FROM sales_lines
    UNION ALL SELECT 'table_rows', 'monthly_revenue', count(*) FROM months
    UNION ALL SELECT 'table_rows', 'customer_segments', count(*) FROM segments
    UNION ALL SELECT 'table_rows', 'sales_forecast', count(*) FROM forecast_sql
    UNION ALL SELECT 'freshness_seconds', '',
        date_diff('second', TIMESTAMP '2024-01-31 23:30:00', TIMESTAMP '2024-02-01 00:00:00')
    UNION ALL SELECT 'winner_mape', series_id, round(min(mape), 4) FROM errors_sql GROUP BY series_id
    UNION ALL SELECT 'segment_size', cluster_label, count(*) FROM segments GROUP BY cluster_label
""")
def health_metrics(s: Source) -> DataFrame:
    """The lines, and three tables as a published version's manifest has them."""
    root = s.scratch("serving")
    version = serving.publish_version(
        {
            "monthly_revenue": sales_queries.monthly(s),
            "customer_segments": customers.customer_segments(customer_queries.lines(s)),
            "sales_forecast": forecast_queries.forecast(s),
        },
        root, PUBLISHED_AT,
    )
    metrics = health.health_metrics(
        {"fact_sales": s.lines("sales")},
        serving.read_manifest(s.spark, root, version), F.lit(AS_OF),
        forecast_queries.comparison(s),
        serving.served_tables(s.spark, root)["customer_segments"],
    )
    return metrics.withColumn("value", F.round("value", 4))


# hourly: a thousand rows per event and type, their age, and a type's share of the hour
HISTORY_SQL = """
    SELECT 'table_rows' AS metric, event_type AS label, date_trunc('hour', ts) AS observed_at,
        1000 * cast(count(*) AS double) AS value FROM events GROUP BY 1, 2, 3
    UNION ALL
    SELECT 'freshness_seconds', event_type, date_trunc('hour', ts),
        cast(date_diff('second', date_trunc('hour', ts), TIMESTAMP '2024-01-31 12:00:00') AS double)
    FROM events GROUP BY 2, 3
    UNION ALL
    SELECT 'winner_mape', event_type, observed_at,
        100.0 * cast(n AS double) / cast(sum(n) OVER (PARTITION BY observed_at) AS double)
    FROM (SELECT event_type, date_trunc('hour', ts) AS observed_at, count(*) AS n FROM events GROUP BY 1, 2)
"""


def history(s: Source) -> DataFrame:
    """An hourly history of all three watched metrics, from the events."""
    hour = F.date_trunc("hour", "ts").alias("observed_at")
    hourly = s.table("events").groupBy(F.col("event_type").alias("label"), hour).agg(
        F.count(F.lit(1)).cast("double").alias("value")
    )
    share = F.lit(100.0) * F.col("value") / F.sum("value").over(Window.partitionBy("observed_at"))
    age = age_seconds(F.lit(dt.datetime(2024, 1, 31, 12)), F.col("observed_at")).cast("double")
    of = lambda metric, value: hourly.select(
        F.lit(metric).alias("metric"), "label", "observed_at", value.alias("value"))
    return union_rows([
        of("table_rows", 1000 * F.col("value")), of("freshness_seconds", age), of("winner_mape", share)
    ])


@query("health_alerts", f"""
    WITH history AS ({HISTORY_SQL}),
    ends AS (SELECT metric, label, max(observed_at) AS last_at,
        arg_max(value, observed_at) AS last_value FROM history GROUP BY metric, label),
    state AS (SELECT h.metric, h.label, last_value,
            last_value - arg_min(value, observed_at) AS change
        FROM history h JOIN ends e ON h.metric = e.metric AND h.label = e.label
        WHERE observed_at >= last_at - INTERVAL 1 HOUR GROUP BY h.metric, h.label, last_value)
    SELECT 'data_stale' AS alert, 'warning' AS severity, metric, label, round(last_value, 4) AS last_value,
        round(change, 4) AS change, last_value > 90000 AS firing
    FROM state WHERE metric = 'freshness_seconds'
    UNION ALL
    SELECT 'rows_dropping', 'critical', metric, label, round(last_value, 4), round(change, 4),
        change < -1000
    FROM state WHERE metric = 'table_rows'
    UNION ALL
    SELECT 'forecast_error_high', 'warning', metric, label, round(last_value, 4), round(change, 4),
        last_value > 50
    FROM state WHERE metric = 'winner_mape'
""")
def health_alerts(s: Source) -> DataFrame:
    """Whether each rule's limit is passed at the end of each series."""
    return health.health_alerts(history(s)).withColumn("last_value", F.round("last_value", 4))


EPISODES_SQL = f"""
    WITH history AS ({HISTORY_SQL}),
    rules AS (SELECT * FROM (VALUES
        ('data_stale', 'warning', 'freshness_seconds', 90000.0, NULL, 300),
        ('rows_dropping', 'critical', 'table_rows', NULL, -1000.0, 600),
        ('forecast_error_high', 'warning', 'winner_mape', 50.0, NULL, 1800))
        AS t(alert, severity, metric, above, below, hold)),
    judged AS (SELECT alert, severity, h.metric, label, observed_at, value, hold,
            coalesce(value > above, value - first_value(value) OVER (PARTITION BY h.metric, label
                ORDER BY observed_at RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) < below) AS is_over
        FROM history h JOIN rules r ON r.metric = h.metric),
    marked AS (SELECT *, lead(observed_at) OVER w AS next_at,
            is_over AND NOT coalesce(lag(is_over) OVER w, false) AS begins
        FROM judged WINDOW w AS (PARTITION BY metric, label ORDER BY observed_at)),
    numbered AS (SELECT *, sum(begins::int) OVER (PARTITION BY metric, label ORDER BY observed_at) AS stretch
        FROM marked),
    started AS (SELECT *, min(observed_at) OVER (PARTITION BY metric, label, stretch) AS started_at
        FROM numbered WHERE is_over),
    stretches AS (SELECT alert, severity, metric, label, started_at,
            min(observed_at) FILTER (date_diff('second', started_at, observed_at) >= hold) AS firing_at,
            nullif(max(coalesce(next_at, TIMESTAMP '9999-01-01 00:00:00')), TIMESTAMP '9999-01-01 00:00:00') AS ended_at,
            arg_max(value, observed_at) AS last_value
        FROM started GROUP BY ALL),
    episodes AS (SELECT *, CASE WHEN ended_at IS NULL AND firing_at IS NULL THEN 'pending'
            WHEN ended_at IS NULL THEN 'firing' WHEN firing_at IS NULL THEN 'lapsed' ELSE 'resolved' END AS state
        FROM stretches)
"""


def episodes(s: Source) -> DataFrame:
    return health.alert_episodes(history(s)).withColumn("last_value", F.round("last_value", 4))


query("alert_episodes", EPISODES_SQL + """
    SELECT alert, severity, metric, label, started_at, firing_at, ended_at,
        round(last_value, 4) AS last_value, state FROM episodes
""")(episodes)
query("alert_states", EPISODES_SQL + """
    SELECT alert, severity, metric, label, started_at,
        CASE WHEN firing_at <= TIMESTAMP '2024-01-15 12:00:00' THEN 'firing' ELSE 'pending' END AS state
    FROM episodes WHERE started_at <= TIMESTAMP '2024-01-15 12:00:00'
        AND (ended_at IS NULL OR ended_at > TIMESTAMP '2024-01-15 12:00:00')
""")(lambda s: health.alert_states(episodes(s), F.lit(dt.datetime(2024, 1, 15, 12))))


@query("fn_freshness", """
    SELECT event_type, cast(date_diff('second', date_trunc('second', max(ts)),
        TIMESTAMP '2024-02-01 00:00:00') AS bigint) AS age_seconds
    FROM events GROUP BY event_type
""")
def fn_freshness(s: Source) -> DataFrame:
    age = age_seconds(F.lit(dt.datetime(2024, 2, 1)), F.max("ts")).alias("age_seconds")
    return s.table("events").groupBy("event_type").agg(age)
