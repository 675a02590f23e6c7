"""Profiles of the flat order lines."""

from __future__ import annotations

from tallymill.operators import profiling, quantiles, sales
from tallymill.plans.registry import query

PROFILED = {
    "row_id": "bigint", "order_id": "bigint", "order_date": "date", "ship_date": "date",
    "ship_mode": "string", "customer_id": "bigint", "customer_name": "string",
    "segment": "string", "country": "string", "state": "string", "city": "string",
    "postal_code": "string", "region": "string", "product_id": "bigint", "category": "string",
    "sub_category": "string", "product_name": "string", "sales": "decimal(12,4)",
    "quantity": "bigint", "discount": "decimal(5,4)", "profit": "decimal(12,4)",
}
MEASURES = ("sales", "quantity", "discount", "profit")
# a whole line; the row number is made to differ, so it cannot tell a repeated line
WHOLE_LINE = tuple(c for c in PROFILED if c != "row_id")

PROFILE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS data_type, count({c}) AS non_null,"
    f" count(*) - count({c}) AS null_count,"
    f" round(100.0 * (count(*) - count({c})) / count(*), 2) AS null_pct,"
    f" count(DISTINCT {c}) AS distinct_count FROM sales_lines"
    for c, kind in PROFILED.items()
)
query("profile_columns", PROFILE_SQL)(lambda s: profiling.profile_columns(s.lines(*PROFILED)))
query("profile_nulls", f"""
    SELECT column_name, null_count, null_pct FROM ({PROFILE_SQL}) WHERE null_count > 0
""")(lambda s: profiling.profile_nulls(profiling.profile_columns(s.lines(*PROFILED))))

query("profile_dates", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, min({c}) AS first_day, max({c}) AS last_day,"
    f" cast(date_diff('day', min({c}), max({c})) AS int) AS span_days,"
    f" count(*) - count({c}) AS invalid_rows FROM sales_lines"
    for c in ("order_date", "ship_date")
))(lambda s: profiling.profile_dates(
    s.lines("order_date", "ship_date"), "order_date", "ship_date"))

query("rows_per_day", """
    SELECT count(*) AS distinct_days, round(cast(sum(n) AS double) / count(*), 1)
            AS avg_rows_per_day,
        (SELECT order_date FROM (SELECT order_date, count(*) AS n FROM sales_lines GROUP BY 1)
            ORDER BY n DESC, order_date LIMIT 1) AS busiest_day,
        max(n) AS busiest_rows
    FROM (SELECT order_date, count(*) AS n FROM sales_lines GROUP BY 1)
""")(lambda s: profiling.rows_per_day(s.lines("order_date"), "order_date"))

query("profile_duplicates", f"""
    SELECT 'duplicate_rows' AS measure,
        count(*) - count(DISTINCT ({', '.join(WHOLE_LINE)})) AS rows FROM sales_lines
    UNION ALL SELECT 'duplicate_order_id_product_id',
        count(*) - count(DISTINCT (order_id, product_id)) FROM sales_lines
    UNION ALL SELECT 'distinct_order_id', count(DISTINCT order_id) FROM sales_lines
    UNION ALL SELECT 'distinct_customer_id', count(DISTINCT customer_id) FROM sales_lines
    UNION ALL SELECT 'distinct_product_id', count(DISTINCT product_id) FROM sales_lines
""")(lambda s: profiling.profile_duplicates(
    s.lines(*WHOLE_LINE),
    ("order_id", "product_id"), ("order_id", "customer_id", "product_id")))

query("profile_numeric", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(v) AS rows, round(avg(v), 4) AS mean,
        round(stddev_samp(v), 4) AS std, min(v) AS min, max(v) AS max,
        round(quantile_cont(v, 0.25), 8) AS q1, round(quantile_cont(v, 0.5), 8) AS median,
        round(quantile_cont(v, 0.75), 8) AS q3
    FROM (SELECT cast({c} AS double) AS v FROM sales_lines)"""
    for c in MEASURES
))(lambda s: profiling.profile_numeric(s.lines(*MEASURES), *MEASURES))

query("outliers_iqr", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(lo, 8) AS lower_bound, round(hi, 8) AS upper_bound,
        count(*) FILTER (v < lo OR v > hi) AS outliers,
        round(100.0 * count(*) FILTER (v < lo OR v > hi) / count(*), 4) AS outlier_pct
    FROM (SELECT cast({c} AS double) AS v FROM sales_lines),
        (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM (
            SELECT quantile_cont(cast({c} AS double), 0.25) AS q1,
                quantile_cont(cast({c} AS double), 0.75) AS q3 FROM sales_lines))
    GROUP BY lo, hi"""
    for c in MEASURES
))(lambda s: quantiles.iqr_outliers(quantiles.value_counts(s.lines(*MEASURES), MEASURES)))

query("negative_values", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} < 0) AS negatives FROM sales_lines"
    for c in MEASURES
))(lambda s: profiling.negative_values(s.lines(*MEASURES), *MEASURES))

query("revenue_by_month_resample", """
    SELECT g.month, coalesce(t.total, 0.0) AS total
    FROM (SELECT cast(unnest(generate_series(
              cast(date_trunc('month', min(order_date)) AS timestamp),
              cast(date_trunc('month', max(order_date)) AS timestamp),
              INTERVAL 1 MONTH)) AS date) AS month FROM sales_lines) g
    LEFT JOIN (SELECT cast(date_trunc('month', order_date) AS date) AS month,
                   cast(round(sum(sales), 2) AS double) AS total
               FROM sales_lines GROUP BY 1) t ON t.month = g.month
""")(lambda s: profiling.monthly_resample(s.lines("order_date", "sales"), "order_date", "sales"))

DIMENSIONS = ("category", "sub_category", "region", "segment")
query("revenue_by_dimension", " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, {d} AS value, cast(round(sum(sales), 2) AS double) AS revenue"
    f" FROM sales_lines GROUP BY {d}"
    for d in DIMENSIONS
))(lambda s: sales.revenue_by_each(s.lines(*DIMENSIONS, "sales"), *DIMENSIONS))

CORRELATED = ("discount", "profit", "sales")
query("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b,"
    f" round(corr(cast({a} AS double), cast({b} AS double)), 3) AS correlation FROM sales_lines"
    for a in CORRELATED for b in CORRELATED
))(lambda s: profiling.correlation_matrix(s.lines(*CORRELATED), *CORRELATED))

query("histogram", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name,
        cast(least(floor((v - lo) * 50 / (hi - lo)) + 1, 50) AS int) AS bin, count(*) AS rows
    FROM (SELECT cast({c} AS double) AS v FROM sales_lines),
        (SELECT min(cast({c} AS double)) AS lo, max(cast({c} AS double)) AS hi FROM sales_lines)
    GROUP BY 1, 2"""
    for c in CORRELATED
))(lambda s: profiling.histogram(s.lines(*CORRELATED), *CORRELATED))
