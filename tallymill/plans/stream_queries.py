"""The event table as a live order stream, run to its end."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.plans.registry import Source, query
from tallymill.streaming import orders

DRAIN = {"availableNow": True}


def messages(s: Source, path: str | None = None) -> DataFrame:
    """Events as broker messages: a JSON value and a timestamp.

    Error events come without an order id, so validation rejects them.
    """
    # a glob, so that the table may be one file or a folder of files
    events = orders.table_source(
        s.spark, path or f"{s.folder}/events*.parquet", s.table("events").schema
    )
    number = F.col("event_id").cast("string")
    order = F.when(F.col("event_type") != "error", F.concat(F.lit("RT-"), number))
    body = F.struct(
        number.alias("event_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
        .alias("event_time"),
        order.alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").cast("bigint").alias("quantity"),
        F.col("value").alias("sales"),
        (F.col("value") - 10).alias("profit"),
    )
    return events.select(
        F.to_json(body).alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )


def delivered_twice(s: Source, run: Callable[[DataFrame], None]) -> None:
    """Run a stream over all events, each sent again in a later micro-batch.

    The earlier half arrives, then its copies, then the later half and its
    copies; the stream is run to its end, and stopped, after each arrival.
    """
    events, path = s.table("events"), s.scratch("resent")
    middle = F.lit(events.agg(F.percentile_approx(F.unix_micros(F.col("ts").cast("timestamp")), 0.5)).first()[0])
    late = F.unix_micros(F.col("ts").cast("timestamp")) > middle
    for half in (~late, ~late, late, late):
        events.filter(half).write.mode("append").parquet(path)
        run(valid(s, path))


def valid(s: Source, path: str | None = None) -> DataFrame:
    return orders.valid_orders(orders.parse_orders(messages(s, path)))


def landed(s: Source, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream into a partitioned table and read the table."""
    path = s.scratch(label)
    orders.store_stream(stream, path, s.scratch("offsets"), DRAIN).awaitTermination()
    return s.spark.read.schema(stream.schema).parquet(path)


def live_table(s: Source) -> DataFrame:
    return landed(s, valid(s), "bronze_orders")


def latest(s: Source, result: DataFrame) -> DataFrame:
    path = s.scratch("latest")
    orders.latest_result(result, path, s.scratch("offsets"), DRAIN).awaitTermination()
    return orders.read_latest(s.spark, path)


def minute_rates(s: Source) -> DataFrame:
    path = s.scratch("rates")
    rates = orders.ingest_rate(valid(s))
    orders.latest_result(rates, path, s.scratch("offsets"), DRAIN, "update").awaitTermination()
    return orders.read_updates(s.spark, path, "window_start")


def plain_time(df: DataFrame, *columns: str) -> DataFrame:
    """Instants as plain UTC timestamps."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


LIVE = "event_id, event_time, order_id, customer_id, category, quantity, sales, profit"


def live_columns(df: DataFrame) -> DataFrame:
    return plain_time(df.select(*LIVE.split(", ")), "event_time")


PARSED = """
    SELECT cast(event_id AS varchar) AS event_id, ts AS event_time,
        CASE WHEN event_type <> 'error' THEN 'RT-' || cast(event_id AS varchar) END AS order_id,
        event_type AS category, cast(regexp_extract(props, '([0-9]+)', 1) AS bigint) AS quantity,
        value AS sales
    FROM events
"""
PARSED_COLUMNS = ("event_id", "event_time", "order_id", "category", "quantity", "sales")

query("stream_source", "SELECT count(*) AS messages, max(ts) AS newest FROM events")(
    lambda s: plain_time(latest(s, messages(s).agg(
        F.count(F.lit(1)).alias("messages"), F.max("timestamp").alias("newest"))), "newest"))
query("stream_parse", PARSED)(lambda s: plain_time(
    landed(s, orders.parse_orders(messages(s)), "parsed").select(*PARSED_COLUMNS), "event_time"))
query("stream_validate", f"SELECT {LIVE} FROM live")(lambda s: live_columns(live_table(s)))
query("stream_rejects", f"""
    SELECT event_id, category FROM ({PARSED}) WHERE order_id IS NULL OR sales < 0 OR sales IS NULL
""")(lambda s: landed(
    s, orders.rejected_orders(orders.parse_orders(messages(s))), "rejected",
).select("event_id", "category"))
query("stream_sink_bronze", """
    SELECT category, count(*) AS events, count(DISTINCT event_id) AS ids FROM live GROUP BY category
""")(lambda s: live_table(s).groupBy("category").agg(
    F.count(F.lit(1)).alias("events"), F.count_distinct("event_id").alias("ids")))


@query("stream_table_source", f"SELECT {LIVE} FROM live")
def stream_table_source(s: Source) -> DataFrame:
    """The landed table read as a stream again and landed once more."""
    stream, path = valid(s), s.scratch("first")
    orders.store_stream(stream, path, s.scratch("offsets"), DRAIN).awaitTermination()
    again = s.spark.readStream.schema(stream.schema).parquet(path)
    return live_columns(landed(s, again, "second"))


@query("stream_foreach_batch", f"SELECT {LIVE} FROM live")
def stream_foreach_batch(s: Source) -> DataFrame:
    """Twice-delivered events through the idempotent per-batch append."""
    path, offsets = s.scratch("serving"), s.scratch("offsets")
    delivered_twice(s, lambda stream: orders.serve_stream(stream, path, offsets, DRAIN).awaitTermination())
    return live_columns(s.spark.read.parquet(path))


@query("stream_dedup", f"SELECT {LIVE} FROM live")
def stream_dedup(s: Source) -> DataFrame:
    """Twice-delivered events, the copies dropped by state or as late."""
    path, offsets = s.scratch("unique"), s.scratch("offsets")
    delivered_twice(s, lambda stream: orders.store_stream(
        orders.deduplicate(stream), path, offsets, DRAIN).awaitTermination())
    return live_columns(s.spark.read.parquet(path))


query("stream_category_kpis", "SELECT * FROM live_kpis")(lambda s: plain_time(
    latest(s, orders.category_kpis(valid(s))), "last_event"))
query("orders_realtime_kpis", "SELECT * FROM live_kpis")(lambda s: plain_time(
    orders.category_kpis(live_table(s)), "last_event"))
query("streaming_status", """
    SELECT count(*) AS events, cast(sum(cast(sales AS decimal(14,2))) AS double) AS revenue
    FROM live
""")(lambda s: orders.stream_status(live_table(s)))
query("stream_ingest_rate", """
    SELECT date_trunc('minute', event_time) AS window_start, count(*) AS events,
        round(count(*) / 60.0, 4) AS events_per_second
    FROM live GROUP BY 1
""")(lambda s: plain_time(minute_rates(s), "window_start"))
query("stream_lag_seconds", """
    SELECT cast(date_diff('second', date_trunc('second', max(event_time)),
        TIMESTAMP '2024-02-01 00:00:00') AS bigint) AS lag_seconds FROM live
""")(lambda s: latest(s, orders.lag_seconds(valid(s), F.lit(dt.datetime(2024, 2, 1)))))
query("stream_total_rows", "SELECT count(*) AS total_rows FROM live")(
    lambda s: latest(s, orders.total_rows(valid(s))))
query("fn_json_parse", PARSED)(lambda s: plain_time(
    landed(s, orders.parse_orders(messages(s)), "json").select(*PARSED_COLUMNS), "event_time"))
