"""Versions of served tables, alerts that must hold, and the certificate of clusters."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallymill.operators import customers, forecasting, health
from tallymill.plans import batch
from tallymill.session import scratch_path
from tallymill.sources import serving
from tallymill.sources.lines import order_lines
from tallymill.sources.tables import write_table

NOON = dt.datetime(2024, 1, 1, 12)


@pytest.fixture
def root(spark):
    return scratch_path(spark, "serving")


def months(spark, *revenues):
    return spark.createDataFrame([(2024, i + 1, r) for i, r in enumerate(revenues)], "year int, month int, revenue double")


def test_digest_ignores_order_and_sees_repeats(spark):
    df = months(spark, 1.5, None, 2.25)
    same = df.orderBy(F.desc("month")).repartition(3)
    assert serving.contents(df).first() == serving.contents(same).first()
    assert serving.contents(df.unionAll(df)).first()["digest"] != serving.contents(df).first()["digest"]
    assert serving.contents(df.limit(0)).first().asDict() == {"rows": 0, "digest": "0"}
    null_and_blank = [spark.createDataFrame([(v,)], "a string") for v in (None, "")]
    assert len({serving.contents(d).first()["digest"] for d in null_and_blank}) == 2


def test_versions_switch_and_go_back(spark, root):
    assert serving.served_version(spark, root) is None
    with pytest.raises(LookupError):
        serving.read_manifest(spark, root)
    first = serving.publish_version({"monthly_revenue": months(spark, 1.0)}, root, NOON, "a")
    second = serving.publish_version(
        {"monthly_revenue": months(spark, 1.0, 2.0), "empty": months(spark)}, root, NOON + dt.timedelta(days=1), "b")
    assert (first, second, serving.served_version(spark, root)) == ("a", "b", "b")
    assert {n: df.count() for n, df in serving.served_tables(spark, root).items()} == {"monthly_revenue": 2, "empty": 0}
    assert {r["table_name"]: r["rows"] for r in serving.read_manifest(spark, root).collect()} == {"monthly_revenue": 2, "empty": 0}
    serving.serve_again(spark, root, "a")
    assert serving.served_version(spark, root) == "a"
    stamp = serving.served_tables(spark, root)["monthly_revenue"].first()["computed_at"]
    assert stamp == NOON
    with pytest.raises(Exception):
        serving.serve_again(spark, root, "never")
    assert serving.served_version(spark, root) == "a"


def test_a_failed_publish_serves_the_old_version(spark, root):
    serving.publish_version({"monthly_revenue": months(spark, 1.0)}, root, NOON, "a")
    broken = months(spark, 1.0).withColumn("revenue", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        serving.publish_version({"monthly_revenue": months(spark, 9.0), "top_products": broken}, root, NOON, "b")
    assert serving.served_version(spark, root) == "a"
    assert serving.served_tables(spark, root)["monthly_revenue"].first()["revenue"] == 1.0
    with pytest.raises(ValueError):
        serving.publish_version({"x": months(spark, 1.0).withColumn("computed_at", F.lit(1))}, root, NOON)


def test_changed_files_are_found(spark, root):
    serving.publish_version({"monthly_revenue": months(spark, 1.0), "other": months(spark, 2.0)}, root, NOON, "a")
    assert serving.changed_tables(spark, root).isEmpty()
    more = months(spark, 7.0).withColumn("computed_at", F.lit(NOON))
    write_table(more, f"{root}/versions/a/other", mode="append")
    assert [(r["table_name"], r["rows"], r["stored_rows"]) for r in serving.changed_tables(spark, root).collect()] == [("other", 1, 2)]


def test_a_failed_check_publishes_nothing(spark, folder, root, monkeypatch):
    raw_path = scratch_path(spark, "raw")
    order_lines(spark, folder).filter("order_id % 50 = 1").write.parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    failing = spark.createDataFrame([("unique", "dim_customer", False)], "check_name string, table_name string, passed boolean")
    monkeypatch.setattr(batch, "verify_warehouse", lambda built: failing)
    with pytest.raises(RuntimeError, match="dim_customer"):
        batch.run_batch(spark, raw, root, NOON, models={"naive": forecasting.forecast_naive})
    assert serving.served_version(spark, f"{root}/serving") is None


def test_alerts_hold_before_they_fire(spark):
    def rows(label, *values, step=5, metric="freshness_seconds"):
        return [(metric, label, NOON + dt.timedelta(minutes=step * i), v) for i, v in enumerate(values)]

    over, fine = 90_001.0, 90_000.0
    history = spark.createDataFrame([
        *rows("open", over), *rows("fires", fine, over, over), *rows("ends", over, over, over, fine),
        *rows("short", over, fine, over, over), *rows("gone", over, None, over), *rows("calm", fine, fine),
        *rows("", 5_000.0, 3_999.0, 3_998.0, 3_997.0, metric="table_rows"),
        *rows("slow", 51.0, 51.0, 51.0, step=10, metric="winner_mape"),
    ], "metric string, label string, observed_at timestamp, value double")
    got = {}
    for r in health.alert_episodes(history).collect():
        minutes = [None if t is None else int((t - NOON).total_seconds() // 60) for t in (r["started_at"], r["firing_at"], r["ended_at"])]
        got.setdefault(r["label"] or r["metric"], []).append((*minutes, r["state"]))
    assert {k: sorted(v) for k, v in got.items()} == {
        "open": [(0, None, None, "pending")], "fires": [(5, 10, None, "firing")], "ends": [(0, 5, 15, "resolved")],
        "short": [(0, None, 5, "lapsed"), (10, 15, None, "firing")], "gone": [(0, 10, None, "firing")],
        "table_rows": [(5, 15, None, "firing")], "slow": [(0, None, None, "pending")],
    }
    states = health.alert_states(health.alert_episodes(history), F.lit(NOON + dt.timedelta(minutes=6)))
    assert {(r["label"], r["state"]) for r in states.collect()} == {
        ("open", "pending"), ("fires", "pending"), ("ends", "firing"), ("gone", "pending"), ("", "pending"), ("slow", "pending")}


def test_certificate_refuses_wrong_clusters(spark):
    rows = [(i, i % 7, 10 * (i % 3), 1.0 * (i % 3)) for i in range(60)]
    base = spark.createDataFrame(rows, "customer_id long, recency_days long, frequency long, monetary double")
    right = customers.nearest_centre(base.withColumn("cluster_id", (F.col("customer_id") % 3).cast("int")))
    assert right.filter("NOT is_nearest").isEmpty()
    wrong = customers.nearest_centre(base.withColumn("cluster_id", (F.col("customer_id") % 2).cast("int")))
    assert not wrong.filter("NOT is_nearest").isEmpty()
    flat = base.withColumn("monetary", F.lit(1.0)).withColumn("cluster_id", F.lit(0))
    assert customers.nearest_centre(flat).filter("NOT is_nearest OR own_distance IS NULL").isEmpty()


