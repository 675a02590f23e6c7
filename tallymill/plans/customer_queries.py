"""Queries on customers: RFM, segments, value and churn."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.expressions import percent
from tallymill.operators import customers, kpis, marts
from tallymill.plans.registry import Source, query
from tallymill.plans.sql_views import half_up
from tallymill.plans.sales_queries import doubles
from tallymill.session import stored


def lines(s: Source) -> DataFrame:
    return s.lines(*customers.CUSTOMER, "order_id", "order_date", "sales")


def rfm(s: Source) -> DataFrame:
    return customers.customer_rfm(lines(s))


query("customer_rfm_base", "SELECT * FROM rfm")(lambda s: customers.rfm_base(lines(s)))
query("customer_rfm_view", f"""
    SELECT customer_id, customer_name, segment,
        cast(date_diff('day', max(order_date), DATE '2002-01-01') AS int) AS recency_days,
        count(DISTINCT order_id) AS frequency,
        cast(round(sum(sales), 2) AS double) AS monetary,
        {half_up('round(sum(sales), 2)', 'count(DISTINCT order_id)')} AS avg_order_value
    FROM sales_lines GROUP BY customer_id, customer_name, segment
""")(lambda s: customers.rfm_view(lines(s), dt.date(2002, 1, 1)))
query("customer_rfm", "SELECT * FROM segments")(rfm)
query("rfm_quintile_ntile", "SELECT customer_id, r_score, f_score, m_score FROM scores")(
    lambda s: customers.rfm_scores(customers.rfm_base(lines(s))).select(
        "customer_id", "r_score", "f_score", "m_score"))
query("rfm_quintile_qcut", """
    SELECT customer_id, r_score, f_score, m_score,
        cast(r_score AS varchar) || cast(f_score AS varchar) || cast(m_score AS varchar)
            AS rfm_score,
        r_score + f_score + m_score AS rfm_sum
    FROM (
        SELECT customer_id,
            6 - greatest(1, cast(ceil((r - 1) * 5.0 / greatest(n - 1, 1)) AS int)) AS r_score,
            greatest(1, cast(ceil((f - 1) * 5.0 / greatest(n - 1, 1)) AS int)) AS f_score,
            greatest(1, cast(ceil((m - 1) * 5.0 / greatest(n - 1, 1)) AS int)) AS m_score
        FROM (SELECT customer_id,
                  row_number() OVER (ORDER BY recency_days, customer_id) AS r,
                  row_number() OVER (ORDER BY frequency, customer_id) AS f,
                  row_number() OVER (ORDER BY monetary, customer_id) AS m,
                  count(*) OVER () AS n
              FROM rfm))
""")(lambda s: customers.rfm_scores(customers.rfm_base(lines(s)), "qcut").select(
    "customer_id", "r_score", "f_score", "m_score", "rfm_score", "rfm_sum"))
query("case_when_label", """
    SELECT cluster_label, count(*) AS customers FROM segments GROUP BY cluster_label
""")(lambda s: rfm(s).groupBy("cluster_label").agg(F.count(F.lit(1)).alias("customers")))
query("label_segments", "SELECT customer_id, rfm_score, cluster_label FROM segments")(
    lambda s: rfm(s).select("customer_id", "rfm_score", "cluster_label"))
query("fn_concat_score", "SELECT customer_id, rfm_score FROM segments")(
    lambda s: rfm(s).select("customer_id", "rfm_score"))
query("segment_summary", "SELECT * FROM segment_stats")(
    lambda s: customers.segment_summary(rfm(s)))
INTELLIGENCE_SQL = """
    SELECT *,
        round(100.0 * (cast(customers AS double) / (SELECT count(*) FROM segments)), 2)
            AS pct_of_customers,
        round(100.0 * (total_monetary / nullif((SELECT cast(sum(cast(monetary AS decimal(18,2)))
            AS double) FROM segments), 0)), 2) AS pct_of_revenue
    FROM segment_stats
"""
query("mart_customer_intelligence", INTELLIGENCE_SQL)(lambda s: customers.customer_intelligence(rfm(s)))


@query("share_of_total", """
    SELECT segment, count(DISTINCT customer_id) AS customers,
        round(100.0 * (cast(count(DISTINCT customer_id) AS double)
            / (SELECT count(DISTINCT customer_id) FROM sales_lines)), 2) AS pct_of_customers
    FROM sales_lines GROUP BY segment
""")
def share_of_total(s: Source) -> DataFrame:
    known = s.lines("customer_id", "segment").distinct()
    sizes = known.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))
    return sizes.withColumn(
        "pct_of_customers",
        percent(F.col("customers"), sizes.agg(F.sum("customers")).scalar()),
    )


CERTIFIED = "true AS is_nearest, 5::BIGINT AS clusters, true AS sizes_agree"


def certified(clustered: DataFrame) -> DataFrame:
    """Customers with the proof of their cluster: nearest to its centre, and five centres with all customers.

    The number of a cluster is the model's choice; that no customer is nearer
    to another centre, and that each centre is the mean of its own, is not.
    """
    clustered = stored(clustered, "clustered")
    centres = customers.cluster_centres(clustered).agg(
        F.count(F.lit(1)).alias("clusters"), F.sum("customers").alias("_in_clusters")
    )
    all_rows = clustered.agg(F.count(F.lit(1)).alias("_rows"))
    facts = centres.crossJoin(all_rows).select(
        "clusters", (F.col("_in_clusters") == F.col("_rows")).alias("sizes_agree")
    )
    proven = customers.nearest_centre(clustered).drop("own_distance", "nearest_distance", "cluster_id")
    return proven.crossJoin(F.broadcast(facts))  # one row


@query("fit_kmeans", f"SELECT *, {CERTIFIED} FROM rfm")
def fit_kmeans(s: Source) -> DataFrame:
    """Customers, each with the certificate of its cluster."""
    base = stored(customers.rfm_base(lines(s)), "rfm")
    return certified(customers.assign_clusters(customers.fit_kmeans(base), base))


query("customer_segments", f"SELECT *, {CERTIFIED} FROM segments")(
    lambda s: certified(customers.customer_segments(lines(s))))
query("stg_customer_segments", """
    SELECT cast(customer_id AS varchar) AS customer_id, customer_name, segment, recency_days,
        frequency, monetary, r_score, f_score, m_score, rfm_score, cluster_label,
        true AS has_cluster
    FROM segments
""")(lambda s: doubles(
    marts.stage(customers.customer_segments(lines(s)), "customer_segments"), "monetary"
).withColumn("has_cluster", F.col("cluster_id").between(0, 4)).drop("cluster_id"))


@query("persist_model", "SELECT count(*) AS customers, cast(0 AS bigint) AS moved FROM rfm")
def persist_model(s: Source) -> DataFrame:
    """A saved and reloaded model puts every customer into the same cluster."""
    base = stored(customers.rfm_base(lines(s)), "rfm")
    model, path = customers.fit_kmeans(base), s.scratch("kmeans")
    customers.save_model(model, path)
    before = customers.assign_clusters(model, base)
    both = customers.assign_clusters(
        customers.load_model(path), before.withColumnRenamed("cluster_id", "first_cluster")
    )
    return both.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(F.col("cluster_id") != F.col("first_cluster")).alias("moved"),
    )


query("kpi_customer_pareto", """
    SELECT customer_id, cast(round(amount, 2) AS double) AS revenue,
        round(100.0 * (cast(so_far AS double) / cast(total AS double)), 4) AS cumulative_pct,
        cast(so_far AS double) / cast(total AS double) <= 0.8 AS in_core
    FROM (SELECT customer_id, amount,
              sum(amount) OVER (ORDER BY amount DESC, customer_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far,
              sum(amount) OVER () AS total
          FROM (SELECT customer_id, sum(sales) AS amount FROM sales_lines GROUP BY customer_id))
""")(lambda s: kpis.customer_pareto(s.lines("customer_id", "sales")))
query("kpi_repeat_purchase_rate", """
    SELECT count(*) AS customers, count(*) FILTER (orders >= 2) AS repeat_customers,
        round(100.0 * (cast(count(*) FILTER (orders >= 2) AS double) / count(*)), 2)
            AS repeat_rate_pct
    FROM (SELECT customer_id, count(DISTINCT order_id) AS orders
          FROM sales_lines GROUP BY customer_id)
""")(lambda s: kpis.repeat_purchase_rate(s.lines("customer_id", "order_id")))
query("kpi_clv_proxy", """
    SELECT customer_id, cast(value AS double) / 100 AS avg_order_value, frequency,
        cast(value * frequency AS double) / 100 AS clv_proxy
    FROM (SELECT customer_id, frequency, (2 * cast(round(monetary * 100) AS bigint) + frequency)
              // (2 * frequency) AS value FROM rfm)
""")(lambda s: kpis.lifetime_value(customers.rfm_view(lines(s))))
query("kpi_churn_flag", """
    SELECT customer_id, max(order_date) AS last_order,
        cast(date_diff('day', max(order_date), (SELECT max(order_date) FROM sales_lines)) AS int)
            AS days_since,
        date_diff('day', max(order_date), (SELECT max(order_date) FROM sales_lines)) > 180
            AS churned
    FROM sales_lines GROUP BY customer_id
""")(lambda s: kpis.churn_flags(s.lines("customer_id", "order_date")))
