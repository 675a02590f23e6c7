"""Views the SQL counterparts build on, in dependency order.

``sales_lines`` is the flat order line in plain SQL. Amounts are decimals
inside and doubles when served, as in the operators.
"""



def half_up(amount: str, count: str, places: int = 2) -> str:
    """``amount / count`` rounded half up in whole numbers, as a double."""
    whole = f"cast(cast({amount} AS decimal(24,4)) * 10000 AS hugeint)"
    parts = f"(cast({count} AS hugeint) * 10000)"
    scaled = f"(2 * abs({whole}) * {10**places} + {parts}) // (2 * {parts})"
    return f"cast(sign({whole}) * ({scaled}) AS double) / {10**places}"


def smoothing_views(series: str, prefix: str) -> dict[str, str]:
    """Holt-Winters over ``series`` (series_id, month, y) by recursion, month by month.

    Three grids of weights in turn, each around the best of the one before;
    every combination is a row that walks through the series. The seasonal
    state is a list of which the first entry is the month at hand. For series
    of 24 months and more, as all of the test tables are.
    """
    def axis(name: str, count: int, half: float) -> str:
        return (f"(SELECT unnest(list_distinct([greatest(0.0, least(1.0, c.{name} - {half} + "
                f"k * {2 * half / (count - 1)!r})) FOR k IN range({count})])) AS {name})")

    views = {
        f"{prefix}_rows": f"""
            SELECT series_id, y, month,
                row_number() OVER (PARTITION BY series_id ORDER BY month) AS t FROM {series}
        """,
        f"{prefix}_begin": f"""
            SELECT series_id, n, slope, first - slope * 6.5 AS start,
                [ys[i] - (first - slope * 6.5 + slope * i) FOR i IN range(1, 13)] AS season
            FROM (SELECT series_id, count(*) AS n, list(y ORDER BY t) AS ys,
                      avg(y) FILTER (t <= 12) AS first,
                      (avg(y) FILTER (t > 12 AND t <= 24) - avg(y) FILTER (t <= 12)) / 12 AS slope
                  FROM {prefix}_rows GROUP BY series_id)
        """,
    }
    best = "SELECT series_id, 0.5::DOUBLE AS alpha, 0.5::DOUBLE AS beta, 0.5::DOUBLE AS gamma FROM " + f"{prefix}_begin"
    for turn, (count, half) in enumerate(((7, 0.5), (5, 0.125), (5, 0.03125))):
        views[f"{prefix}_grid{turn}"] = f"""
            SELECT b.*, a.alpha, e.beta, g.gamma
            FROM ({best}) c JOIN {prefix}_begin b ON b.series_id = c.series_id,
                LATERAL {axis('alpha', count, half)} a, LATERAL {axis('beta', count, half)} e,
                LATERAL {axis('gamma', count, half)} g
        """
        views[f"{prefix}_walk{turn}"] = f"""
            SELECT series_id, n, alpha, beta, gamma, start, slope, 0::BIGINT AS t,
                start AS level, slope AS trend, season, 0.0::DOUBLE AS squares, 0.0::DOUBLE AS errors
            FROM {prefix}_grid{turn}
            UNION ALL
            SELECT series_id, n, alpha, beta, gamma, start, slope, t, raised,
                beta * (raised - level) + (1 - beta) * trend,
                list_append(season[2:12], gamma * (y - expected) + (1 - gamma) * season[1]),
                squares + error * error, errors + error
            FROM (SELECT w.* EXCLUDE (t), w.t + 1 AS t, r.y, w.level + w.trend AS expected,
                      r.y - (w.level + w.trend) - w.season[1] AS error,
                      w.alpha * (r.y - w.season[1]) + (1 - w.alpha) * (w.level + w.trend) AS raised
                  FROM {prefix}_walk{turn} w
                  JOIN {prefix}_rows r ON r.series_id = w.series_id AND r.t = w.t + 1)
        """
        views[f"{prefix}_best{turn}"] = f"""
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_id
                ORDER BY squares, alpha, beta, gamma) AS place
                FROM {prefix}_walk{turn} WHERE t = n) WHERE place = 1
        """
        best = f"SELECT series_id, alpha, beta, gamma FROM {prefix}_best{turn}"
    views[f"{prefix}_fit"] = f"""
        SELECT *, sqrt((squares - errors * errors / n) / (n - 1)) AS spread FROM {prefix}_best2
    """
    views[f"{prefix}_sql"] = f"""
        SELECT series_id, cast(last_month + to_months(step) AS date) AS forecast_month,
            'ets' AS model_name, greatest(future, 0.0) AS yhat,
            future - 1.96 * spread AS yhat_lower, future + 1.96 * spread AS yhat_upper
        FROM (SELECT f.series_id, step, spread, last_month,
                  level + step * trend + season[(step - 1) % 12 + 1] AS future
              FROM {prefix}_fit f JOIN (SELECT series_id, max(month) AS last_month
                  FROM {series} GROUP BY series_id) m ON m.series_id = f.series_id, steps)
    """
    return views


VIEWS = {
    "sales_lines": """
        SELECT
            (l_partkey + l_suppkey + l_linenumber) % 4096 * 4294967296 + row_number() OVER (
                PARTITION BY l_orderkey, (l_partkey + l_suppkey + l_linenumber) % 4096
                ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                    l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
            ) AS row_id,
            l_orderkey AS order_id,
            cast(o_orderdate AS date) AS order_date,
            cast(l_shipdate AS date) AS ship_date,
            o_orderpriority AS ship_mode,
            o_custkey AS customer_id,
            c_name AS customer_name,
            c_mktsegment AS segment,
            r_name AS country,
            'CITY_' || cast(o_custkey % 100 AS varchar) AS city,
            n_name AS state,
            CASE WHEN n_nationkey % 5 = 0 THEN NULL
                 ELSE cast(10000 + n_nationkey AS varchar) END AS postal_code,
            r_name AS region,
            l_partkey AS product_id,
            p_type AS category,
            p_brand AS sub_category,
            p_name AS product_name,
            cast(l_extendedprice AS decimal(12,4)) AS sales,
            cast(l_quantity AS bigint) AS quantity,
            cast(l_discount AS decimal(5,4)) AS discount,
            cast(cast(l_extendedprice AS decimal(12,2)) * (1 - cast(l_discount AS decimal(5,2)))
                - cast(p_retailprice AS decimal(12,2)) * cast(l_quantity AS decimal(6,0))
                AS decimal(12,4)) AS profit
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        JOIN part ON l_partkey = p_partkey
    """,
    "months": f"""
        SELECT
            cast(year(order_date) AS int) AS year,
            cast(month(order_date) AS int) AS month,
            strftime(order_date, '%b') AS month_name,
            cast(round(sum(sales), 2) AS double) AS revenue,
            cast(round(sum(profit), 2) AS double) AS profit,
            count(DISTINCT order_id) AS orders,
            {half_up('sum(sales)', 'count(sales)')} AS avg_line_value
        FROM sales_lines
        GROUP BY 1, 2, 3
    """,
    "categories": """
        SELECT category, sub_category,
            cast(round(sum(sales), 2) AS double) AS revenue,
            cast(round(sum(profit), 2) AS double) AS profit,
            cast(sum(quantity) AS bigint) AS units
        FROM sales_lines GROUP BY category, sub_category
    """,
    "places": """
        SELECT region, state,
            cast(round(sum(sales), 2) AS double) AS revenue,
            cast(round(sum(profit), 2) AS double) AS profit
        FROM sales_lines GROUP BY region, state
    """,
    "products": """
        SELECT product_id, product_name, category,
            cast(round(sum(sales), 2) AS double) AS revenue,
            cast(round(sum(profit), 2) AS double) AS profit,
            cast(sum(quantity) AS bigint) AS units
        FROM sales_lines GROUP BY product_id, product_name, category
    """,
    "rfm": """
        SELECT customer_id, customer_name, segment,
            cast(date_diff('day', max(order_date),
                (SELECT max(order_date) FROM sales_lines)) AS int) AS recency_days,
            count(DISTINCT order_id) AS frequency,
            cast(round(sum(sales), 2) AS double) AS monetary
        FROM sales_lines GROUP BY customer_id, customer_name, segment
    """,
    "scores": """
        SELECT *,
            cast(6 - ntile(5) OVER (ORDER BY recency_days, customer_id) AS int) AS r_score,
            cast(ntile(5) OVER (ORDER BY frequency, customer_id) AS int) AS f_score,
            cast(ntile(5) OVER (ORDER BY monetary, customer_id) AS int) AS m_score
        FROM rfm
    """,
    "segments": """
        SELECT *,
            cast(r_score AS varchar) || cast(f_score AS varchar) || cast(m_score AS varchar)
                AS rfm_score,
            CASE
                WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                WHEN r_score >= 3 AND f_score >= 4 AND m_score >= 3 THEN 'Loyal Customers'
                WHEN r_score >= 4 AND f_score >= 2 AND m_score >= 2 THEN 'Potential Loyalists'
                WHEN r_score <= 2 AND f_score >= 3 AND m_score >= 3 THEN 'At Risk'
                WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
                WHEN r_score >= 4 AND f_score = 1 THEN 'New Customers'
                ELSE 'Need Attention'
            END AS cluster_label
        FROM scores
    """,
    "segment_stats": f"""
        SELECT cluster_label, count(*) AS customers,
            {half_up('sum(recency_days)', 'count(*)', 1)} AS avg_recency_days,
            {half_up('sum(frequency)', 'count(*)')} AS avg_frequency,
            {half_up('sum(cast(monetary AS decimal(18,2)))', 'count(*)')} AS avg_monetary,
            cast(sum(cast(monetary AS decimal(18,2))) AS double) AS total_monetary
        FROM segments GROUP BY cluster_label
    """,
    "dim_customer_sql": """
        SELECT cast(row_number() OVER (ORDER BY customer_id) AS int) AS customer_key,
            customer_id, customer_name, segment
        FROM (SELECT DISTINCT customer_id, customer_name, segment FROM sales_lines)
    """,
    "dim_product_sql": """
        SELECT cast(row_number() OVER (ORDER BY product_id) AS int) AS product_key,
            product_id, product_name, category, sub_category
        FROM (SELECT DISTINCT product_id, product_name, category, sub_category FROM sales_lines)
    """,
    "dim_region_sql": """
        SELECT cast(row_number() OVER (
                ORDER BY country NULLS FIRST, region NULLS FIRST, state NULLS FIRST,
                    city NULLS FIRST, postal_code NULLS FIRST) AS int) AS region_key,
            country, region, state, city, postal_code
        FROM (SELECT DISTINCT country, region, state, city, postal_code FROM sales_lines)
    """,
    "dim_ship_mode_sql": """
        SELECT cast(row_number() OVER (ORDER BY ship_mode) AS int) AS ship_mode_key, ship_mode
        FROM (SELECT DISTINCT ship_mode FROM sales_lines WHERE ship_mode IS NOT NULL)
    """,
    "dim_date_sql": """
        SELECT
            cast(strftime(full_date, '%Y%m%d') AS int) AS date_key,
            full_date,
            cast(year(full_date) AS int) AS year,
            cast(quarter(full_date) AS int) AS quarter,
            cast(month(full_date) AS int) AS month,
            strftime(full_date, '%b') AS month_name,
            cast(week(full_date) AS int) AS week,
            cast(dayofweek(full_date) + 1 AS int) AS day_of_week,
            strftime(full_date, '%a') AS day_name,
            dayofweek(full_date) IN (0, 6) AS is_weekend
        FROM (
            SELECT cast(unnest(generate_series(
                cast(least(min(order_date), min(ship_date)) AS timestamp),
                cast(greatest(max(order_date), max(ship_date)) AS timestamp),
                INTERVAL 1 DAY)) AS date) AS full_date
            FROM sales_lines
        )
    """,
    "fact_sql": """
        SELECT s.order_id, s.row_id, c.customer_key, p.product_key, r.region_key,
            m.ship_mode_key,
            cast(strftime(s.order_date, '%Y%m%d') AS int) AS order_date_key,
            cast(strftime(s.ship_date, '%Y%m%d') AS int) AS ship_date_key,
            cast(s.sales AS double) AS sales, s.quantity,
            cast(s.discount AS double) AS discount, cast(s.profit AS double) AS profit,
            cast(year(s.order_date) AS int) AS order_year
        FROM sales_lines s
        JOIN dim_customer_sql c ON c.customer_id = s.customer_id
        JOIN dim_product_sql p ON p.product_id = s.product_id
        JOIN dim_region_sql r ON r.country IS NOT DISTINCT FROM s.country
            AND r.region IS NOT DISTINCT FROM s.region
            AND r.state IS NOT DISTINCT FROM s.state
            AND r.city IS NOT DISTINCT FROM s.city
            AND r.postal_code IS NOT DISTINCT FROM s.postal_code
        JOIN dim_ship_mode_sql m ON m.ship_mode = s.ship_mode
    """,
    "series_sql": """
        SELECT g.series_id, g.month, coalesce(s.y, 0.0) AS y
        FROM (
            SELECT category AS series_id,
                cast(unnest(generate_series(
                    cast(date_trunc('month', min(order_date)) AS timestamp),
                    cast(date_trunc('month', max(order_date)) AS timestamp),
                    INTERVAL 1 MONTH)) AS date) AS month
            FROM sales_lines GROUP BY category
        ) g
        LEFT JOIN (
            SELECT category AS series_id, cast(date_trunc('month', order_date) AS date) AS month,
                cast(round(sum(sales), 2) AS double) AS y
            FROM sales_lines GROUP BY 1, 2
        ) s ON s.series_id = g.series_id AND s.month = g.month
    """,
    "train_sql": """
        SELECT series_id, month, y FROM (
            SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS back
            FROM series_sql) WHERE back > 6
    """,
    "test_sql": """
        SELECT series_id, month, y FROM (
            SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS back
            FROM series_sql) WHERE back <= 6
    """,
    "steps": "SELECT cast(unnest(generate_series(1, 6)) AS int) AS step",
    "baseline_sql": """
        SELECT series_id,
            cast(last_month + to_months(step) AS date) AS forecast_month,
            model_name, yhat,
            cast(NULL AS double) AS yhat_lower, cast(NULL AS double) AS yhat_upper
        FROM (
            SELECT series_id, max(month) AS last_month, 'naive' AS model_name,
                arg_max(y, month) AS yhat
            FROM series_sql GROUP BY series_id
            UNION ALL
            SELECT series_id, max(month), 'baseline_ma', avg(y) FROM (
                SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS back
                FROM series_sql) WHERE back <= 3 GROUP BY series_id
        ), steps
    """,
    **smoothing_views("series_sql", "ets"),
    **smoothing_views("train_sql", "ets_train"),
    "models_sql": "SELECT * FROM baseline_sql UNION ALL SELECT * FROM ets_sql",
    "holdout_sql": """
        SELECT t.series_id, p.model_name, t.month, t.y, p.yhat
        FROM test_sql t JOIN (
            SELECT series_id, 'naive' AS model_name, arg_max(y, month) AS yhat
            FROM train_sql GROUP BY series_id
            UNION ALL
            SELECT series_id, 'baseline_ma', avg(y) FROM (
                SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY month DESC) AS back
                FROM train_sql) WHERE back <= 3 GROUP BY series_id
        ) p ON p.series_id = t.series_id
        UNION ALL
        SELECT t.series_id, e.model_name, t.month, t.y, e.yhat
        FROM test_sql t JOIN ets_train_sql e
            ON e.series_id = t.series_id AND e.forecast_month = t.month
    """,
    "errors_sql": """
        SELECT series_id, model_name,
            100 * avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) AS mape,
            sqrt(avg((y - yhat) * (y - yhat))) AS rmse
        FROM holdout_sql GROUP BY series_id, model_name
    """,
    "winner_sql": """
        SELECT series_id, model_name AS winning_model FROM (
            SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY mape, model_name) AS place
            FROM errors_sql) WHERE place = 1
    """,
    "forecast_sql": """
        SELECT b.series_id, forecast_month, model_name,
            round(yhat, 2) AS yhat, round(yhat_lower, 2) AS yhat_lower,
            round(yhat_upper, 2) AS yhat_upper, model_name = winning_model AS is_winner
        FROM models_sql b JOIN winner_sql w ON w.series_id = b.series_id
    """,
    "live": """
        SELECT cast(event_id AS varchar) AS event_id, ts AS event_time,
            'RT-' || cast(event_id AS varchar) AS order_id, cast(user_id AS varchar) AS customer_id,
            event_type AS category,
            cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS quantity,
            value AS sales, value - 10 AS profit
        FROM events WHERE event_type <> 'error' AND value >= 0
    """,
    "live_kpis": f"""
        SELECT category, count(*) AS events, cast(sum(quantity) AS bigint) AS total_units,
            cast(sum(cast(sales AS decimal(14,2))) AS double) AS revenue,
            cast(sum(cast(profit AS decimal(14,2))) AS double) AS profit,
            {half_up('sum(cast(sales AS decimal(14,2)))', 'count(*)')} AS avg_order_value,
            max(event_time) AS last_event
        FROM live GROUP BY category
    """,
}
