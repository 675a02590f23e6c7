"""The order stream with bad, resent and late events."""

from __future__ import annotations

import json

import pytest

from tallymill.session import scratch_path
from tallymill.streaming import orders

DRAIN = {"availableNow": True}


def event(number, minute=0, sales=10.0, **fields):
    base = {
        "event_id": f"e{number}", "order_id": f"o{number}", "category": "Tech", "quantity": 2,
        "event_time": f"2024-01-01T10:{minute:02d}:00+00:00", "sales": sales, "profit": 1.0,
    }
    return json.dumps({k: v for k, v in (base | fields).items() if v is not None})


@pytest.fixture
def feed(spark):
    """A folder of message files, read as a stream one file at a time."""
    path = scratch_path(spark, "feed")

    def put(*values):
        rows = [(v, None) for v in values]
        spark.createDataFrame(rows, "value string, timestamp timestamp").coalesce(1) \
            .write.mode("append").parquet(path)

    def stream():
        return orders.table_source(
            spark, path, "value string, timestamp timestamp", maxFilesPerTrigger="1")

    return put, stream


def land(spark, stream, label="landed"):
    path = scratch_path(spark, label)
    orders.store_stream(stream, path, scratch_path(spark, "offsets"), DRAIN).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def test_validation_splits_the_stream(spark, feed):
    put, stream = feed
    put(event(1), event(2, sales=-1.0), event(3, sales=None), event(None, event_id=None),
        event(5, order_id=None), "{not json", event(7, event_time="soon"), event(8, sales=0.0))
    parsed = orders.parse_orders(stream())
    good = land(spark, orders.valid_orders(parsed))
    bad = land(spark, orders.rejected_orders(parsed), "rejected")
    assert sorted(r["event_id"] for r in good.collect()) == ["e1", "e7", "e8"]
    assert good.filter("event_id = 'e7'").first()["event_time"] is None
    assert bad.count() == 5


def test_resent_events_are_dropped_within_the_watermark(spark, feed):
    put, stream = feed
    put(event(1, 1), event(2, 2), event(1, 1))
    put(event(2, 2), event(3, 3))
    unique = orders.deduplicate(orders.valid_orders(orders.parse_orders(stream())), "1 hour")
    assert sorted(r["event_id"] for r in land(spark, unique).collect()) == ["e1", "e2", "e3"]


def test_a_late_copy_does_not_take_the_place_of_a_good_one(spark, feed):
    put, stream = feed
    put(event(1, 50))
    put(event(9, event_time="2024-01-01T08:00:00+00:00"), event(9, 45))
    unique = orders.deduplicate(orders.valid_orders(orders.parse_orders(stream())), "1 hour")
    assert sorted(r["event_id"] for r in land(spark, unique).collect()) == ["e1", "e9"]


def test_a_second_feed_leaves_the_rows_of_the_first(spark, feed):
    put, stream = feed
    path = scratch_path(spark, "serving")
    put(event(1, 1), event(2, 2))
    valid = orders.valid_orders(orders.parse_orders(stream()))
    orders.serve_stream(valid, path, scratch_path(spark, "offsets"), DRAIN).awaitTermination()
    put(event(3, 3))
    orders.serve_stream(valid, path, scratch_path(spark, "offsets"), DRAIN).awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(path).collect()) == ["e1", "e2", "e3"]


def test_an_empty_batch_writes_nothing(spark):
    path = scratch_path(spark, "empty")
    orders.append_new(spark.createDataFrame([], "event_id string, n int"), 0, path)
    orders.append_new(spark.createDataFrame([("a", 1)], "event_id string, n int"), 1, path)
    assert [r["batch_id"] for r in spark.read.parquet(path).collect()] == [1]


def test_serving_table_has_each_event_once(spark, feed):
    put, stream = feed
    put(event(1, 1), event(2, 2), event(1, 1))
    put(event(2, 2), event(3, 3))
    path, offsets = scratch_path(spark, "serving"), scratch_path(spark, "offsets")
    valid = orders.valid_orders(orders.parse_orders(stream()))
    orders.serve_stream(valid, path, offsets, DRAIN).awaitTermination()
    put(event(1, 1), event(4, 4))
    orders.serve_stream(valid, path, offsets, DRAIN).awaitTermination()
    ids = sorted(r["event_id"] for r in spark.read.parquet(path).collect())
    assert ids == ["e1", "e2", "e3", "e4"]


def test_a_replayed_batch_changes_nothing(spark):
    path = scratch_path(spark, "replay")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "event_id string, n int")
    more = spark.createDataFrame([("b", 2), ("c", 3)], "event_id string, n int")
    for batch, number in ((rows, 0), (more, 1), (more, 1), (rows, 0)):
        orders.append_new(batch, number, path)
    assert sorted(r["event_id"] for r in spark.read.parquet(path).collect()) == ["a", "b", "c"]


def test_live_kpis_follow_the_stream(spark, feed):
    put, stream = feed
    path, offsets = scratch_path(spark, "kpis"), scratch_path(spark, "offsets")
    put(event(1, 1), event(2, 5, sales=20.0, category="Desk"))
    kpis = orders.category_kpis(orders.valid_orders(orders.parse_orders(stream())))
    orders.latest_result(kpis, path, offsets, DRAIN).awaitTermination()
    put(event(3, 9, sales=15.0))
    orders.latest_result(kpis, path, offsets, DRAIN).awaitTermination()
    got = {r["category"]: (r["events"], r["revenue"], r["avg_order_value"])
           for r in orders.read_latest(spark, path).collect()}
    assert got == {"Tech": (2, 25.0, 12.5), "Desk": (1, 20.0, 20.0)}


def test_rates_keep_the_newest_count_of_a_window(spark, feed):
    put, stream = feed
    path, offsets = scratch_path(spark, "rates"), scratch_path(spark, "offsets")
    for values in ((event(1, 1), event(2, 2)), (event(3, 2),)):
        put(*values)
        rates = orders.ingest_rate(orders.valid_orders(orders.parse_orders(stream())))
        orders.latest_result(rates, path, offsets, DRAIN, "update").awaitTermination()
    rows = orders.read_updates(spark, path, "window_start").orderBy("window_start").collect()
    assert [(r["events"], r["events_per_second"]) for r in rows] == [(1, 0.0167), (2, 0.0333)]
