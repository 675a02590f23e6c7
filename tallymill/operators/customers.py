"""Recency, frequency and monetary value of customers, and their segments."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.expressions import (
    cents, exact_ratio, mean, percent, score_text, segment_label,
)
from tallymill.operators.ranges import bucket_columns
from tallymill.session import stored

ATTRIBUTES = ("customer_name", "segment")
CUSTOMER = ("customer_id", *ATTRIBUTES)
FEATURES = ("recency_days", "frequency", "monetary")


def rfm_base(lines: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Days since the last order, distinct orders and revenue per customer.

    One row per id: of conflicting names or segments the smallest pair is
    kept, as in the customer dimension. Without ``as_of`` the days count back
    from the latest order of any customer, taken from the grouped rows, which
    are written once for that. Star lines are grouped by the surrogate key as
    well, so that those dealt out by it in a join are not dealt out again.
    """
    keys = [c for c in ("customer_key", "customer_id") if c in lines.columns]
    grouped = lines.groupBy(*keys).agg(
        F.min(F.struct(*ATTRIBUTES)).alias("_who"),
        F.max("order_date").alias("_last"),
        F.count_distinct("order_id").alias("frequency"),
        cents(F.sum("sales")).alias("monetary"),
    ).select("customer_id", "_who.*", "_last", "frequency", "monetary")
    if as_of is None:
        grouped = stored(grouped, "rfm-customers")
        anchor = grouped.agg(F.max("_last")).scalar()
    else:
        anchor = F.lit(as_of)
    return grouped.select(
        *CUSTOMER, F.datediff(anchor, "_last").alias("recency_days"), "frequency", "monetary"
    )


def rfm_view(lines: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """The base with the average order value."""
    value = exact_ratio(F.col("monetary"), F.col("frequency"))
    return rfm_base(lines, as_of).withColumn("avg_order_value", value)


def rfm_scores(base: DataFrame, method: str = "ntile") -> DataFrame:
    """Quintile scores 1 (worst) to 5 (best); ties go by customer id.

    ``method='ntile'`` fills the quintiles like SQL NTILE, ``'qcut'`` cuts the
    ranks at their linear quantiles.
    """
    metrics = (("recency_days", "r_rank"), ("frequency", "f_score"), ("monetary", "m_score"))
    return (
        bucket_columns(base, "customer_id", metrics, 5, method)
        .withColumn("r_score", 6 - F.col("r_rank"))
        .withColumn("rfm_score", score_text())
        .withColumn("rfm_sum", F.expr("r_score + f_score + m_score"))
        .select(*base.columns, "r_score", "f_score", "m_score", "rfm_score", "rfm_sum")
    )


def label_segments(scored: DataFrame) -> DataFrame:
    return scored.withColumn("cluster_label", segment_label())


def customer_rfm(
    lines: DataFrame, as_of: dt.date | None = None, method: str = "ntile"
) -> DataFrame:
    """Customers with measures, scores and segment name."""
    return label_segments(rfm_scores(rfm_base(lines, as_of), method)).drop("rfm_sum")


def kmeans_stages(k: int = 5, seed: int = 42, iterations: int = 50) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(FEATURES), outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
        KMeans(featuresCol="_features", predictionCol="cluster_id", k=k, seed=seed,
               maxIter=iterations),
    ])


def fit_kmeans(rfm: DataFrame, k: int = 5, seed: int = 42) -> PipelineModel:
    return kmeans_stages(k, seed).fit(rfm)


def assign_clusters(model: PipelineModel, rfm: DataFrame) -> DataFrame:
    return model.transform(rfm).drop("_raw", "_features")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def customer_segments(
    lines: DataFrame, as_of: dt.date | None = None, k: int = 5, seed: int = 42
) -> DataFrame:
    """``customer_rfm`` plus the KMeans cluster of each customer.

    KMeans reads its input many times, so the scored customers are stored first.
    """
    return clustered_segments(stored(customer_rfm(lines, as_of), "rfm"), k, seed)


def clustered_segments(rfm: DataFrame, k: int = 5, seed: int = 42) -> DataFrame:
    """A written table of scored customers plus the cluster of each."""
    columns = [c for c in rfm.columns if c != "cluster_label"]
    clustered = assign_clusters(fit_kmeans(rfm, k, seed), rfm)
    return clustered.select(*columns, "cluster_id", "cluster_label")


def cluster_centres(clustered: DataFrame) -> DataFrame:
    """``cluster_id``, ``customers``, and the mean of each scaled feature, as a table.

    Features are scaled as the model scales them: less the mean, by the sample
    deviation over all customers; a feature that never varies is 0.
    """
    scaled = scaled_features(clustered)
    return scaled.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("customers"), *(F.avg(f"z_{c}").alias(f"c_{c}") for c in FEATURES)
    )


def scaled_features(clustered: DataFrame) -> DataFrame:
    """``clustered`` with a ``z_`` column for each feature."""
    known = clustered.agg(
        *(F.avg(c).alias(f"mean_{c}") for c in FEATURES), *(F.stddev_samp(c).alias(f"sd_{c}") for c in FEATURES)
    )
    both = clustered.crossJoin(F.broadcast(known))  # one row
    z = {
        f"z_{c}": F.when(F.col(f"sd_{c}") > 0, (F.col(c) - F.col(f"mean_{c}")) / F.col(f"sd_{c}")).otherwise(0.0)
        for c in FEATURES
    }
    return both.withColumns(z).select(*clustered.columns, *z)


def nearest_centre(clustered: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """A certificate of the clusters: per customer, whether no other centre is nearer than its own.

    The centres are the means of their own members, so if every customer is
    nearest to its own, no step of the algorithm can move anything. k rows of
    centres are broadcast. Ties and rounding are within ``tolerance`` of the
    squared distance.
    """
    scaled = scaled_features(clustered)
    centres = cluster_centres(clustered)
    packed = F.broadcast(centres.agg(F.collect_list(F.struct("cluster_id", *(f"c_{c}" for c in FEATURES))).alias("centres")))

    def distance(centre: Column) -> Column:
        parts = [(F.col(f"z_{c}") - centre[f"c_{c}"]) * (F.col(f"z_{c}") - centre[f"c_{c}"]) for c in FEATURES]
        return sum(parts[1:], parts[0])

    own = F.filter("centres", lambda c: c["cluster_id"] == F.col("cluster_id"))[0]
    nearest = F.array_min(F.transform("centres", distance))
    return scaled.crossJoin(packed).select(
        *clustered.columns, distance(own).alias("own_distance"), nearest.alias("nearest_distance"),
        (distance(own) <= nearest + tolerance).alias("is_nearest"),
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    """Size and averages of each segment."""
    return segments.groupBy("cluster_label").agg(
        F.count(F.lit(1)).alias("customers"),
        mean(F.col("recency_days"), 1).alias("avg_recency_days"),
        mean(F.col("frequency")).alias("avg_frequency"),
        mean(_money("monetary")).alias("avg_monetary"),
        cents(F.sum(_money("monetary"))).alias("total_monetary"),
    )


def customer_intelligence(segments: DataFrame) -> DataFrame:
    """The segment summary with shares of all customers and of all revenue.

    The shares are taken over the handful of segment rows.
    """
    totals = segments.agg(
        F.count(F.lit(1)).alias("customers"), F.sum(_money("monetary")).alias("revenue")
    )
    customers, revenue = totals.select("customers").scalar(), totals.select("revenue").scalar()
    return segment_summary(segments).withColumns({
        "pct_of_customers": percent(F.col("customers"), customers),
        "pct_of_revenue": percent(F.col("total_monetary"), revenue),
    })


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")
