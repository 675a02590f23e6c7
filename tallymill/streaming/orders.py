"""The live order stream: parse, validate, deduplicate, store, serve."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallymill.functions.expressions import age_seconds, cents, mean
from tallymill.sources.publish import append_jdbc

# The fields of an order event.
EVENT_SCHEMA = (
    "event_id string, event_time string, order_id string, customer_id string,"
    " customer_name string, segment string, category string, sub_category string,"
    " product_id string, region string, ship_mode string, quantity bigint,"
    " sales double, discount double, profit double"
)
EVENT_FIELDS = tuple(field.split()[0] for field in EVENT_SCHEMA.split(","))


def kafka_source(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
        .option("failOnDataLoss", "false")
        .load()
    )


def table_source(
    spark: SparkSession, path: str, schema: StructType | str, format: str = "parquet", **options: str
) -> DataFrame:
    """A table as a stream: rows of new files arrive as they are added."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def parse_orders(raw: DataFrame) -> DataFrame:
    """(value, timestamp) messages as order events; an unreadable time is NULL."""
    event = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    return (
        raw.select(event.alias("e"), F.col("timestamp").alias("kafka_ts"))
        .select("e.*", "kafka_ts")
        .withColumn("event_time", F.try_to_timestamp("event_time"))
        .withColumn("_ingested_at", F.current_timestamp())
    )


def is_valid() -> Column:
    """Ids and a non-negative amount are there (never NULL itself)."""
    known = F.col("event_id").isNotNull() & F.col("order_id").isNotNull()
    return known & F.coalesce(F.col("sales") >= 0, F.lit(False))


def valid_orders(parsed: DataFrame) -> DataFrame:
    return parsed.filter(is_valid())


def rejected_orders(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~is_valid())


def deduplicate(orders: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Drop replays of an event id. State is kept only within the watermark.

    Of several copies the first on-time one arrives; a late copy never takes
    its place, wherever the two stand in a batch.
    """
    return orders.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark(["event_id"])


def store_stream(
    orders: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    partition_by: tuple[str, ...] = ("category",),
    format: str = "parquet",
) -> StreamingQuery:
    """Append a stream to a partitioned table, exactly once."""
    return (
        orders.writeStream.format(format).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start(path)
    )


def append_new(
    batch: DataFrame, batch_id: int, path: str, key: str = "event_id", feed: str = "0"
) -> None:
    """Put the batch's unseen keys into their own folder of the table at ``path``.

    The folder is named after the feed and the batch and replaced when that
    batch is replayed, so neither a replay, nor a resent key, nor another feed
    into the same table can add a row twice or take one away. Of the stored
    rows only the key column is read, and it is not shuffled while the batch's
    keys are small enough to broadcast. An empty batch writes nothing.
    """
    spark = batch.sparkSession
    rest = F.min(F.struct(*(c for c in batch.columns if c != key))).alias("_row")
    fresh = batch.groupBy(key).agg(rest).select(key, "_row.*").persist()
    try:
        if fresh.isEmpty():
            return
        unseen = fresh
        try:
            table = spark.read.schema(f"{key} string, feed string, batch_id bigint").parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            earlier = table.filter((F.col("feed") != feed) | (F.col("batch_id") < batch_id)).select(key)
            resent = earlier.join(fresh.select(key), key, "left_semi")
            unseen = fresh.join(resent, key, "left_anti")
        unseen.write.mode("overwrite").parquet(f"{path}/feed={feed}/batch_id={batch_id}")
    finally:
        fresh.unpersist()


def serve_stream(
    orders: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Feed the serving table, one idempotent append per micro-batch.

    The checkpoint names the feed: batch numbers begin anew with a new one.
    """
    feed = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]

    def write(batch: DataFrame, batch_id: int) -> None:
        append_new(batch.select(*EVENT_FIELDS), batch_id, path, feed=f"f{feed}")

    return (
        orders.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def serve_stream_jdbc(
    orders: DataFrame, url: str, table: str, checkpoint: str, trigger: dict | None = None,
    **options: str,
) -> StreamingQuery:
    """Append each non-empty micro-batch to a database table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            append_jdbc(batch.select(*EVENT_FIELDS), url, table, **options)

    return (
        orders.writeStream.foreachBatch(write).outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def category_kpis(orders: DataFrame) -> DataFrame:
    """Live KPIs per category, over a stream or a stored table."""
    sales, profit = (F.col(c).cast("decimal(14,2)") for c in ("sales", "profit"))
    return orders.groupBy("category").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("quantity").alias("total_units"),
        cents(F.sum(sales)).alias("revenue"),
        cents(F.sum(profit)).alias("profit"),
        mean(sales).alias("avg_order_value"),
        F.max("event_time").alias("last_event"),
    )


def stream_status(orders: DataFrame) -> DataFrame:
    """Events and revenue so far, as one row."""
    revenue = cents(F.sum(F.col("sales").cast("decimal(14,2)")))
    return orders.agg(F.count(F.lit(1)).alias("events"), revenue.alias("revenue"))


def ingest_rate(orders: DataFrame, window: str = "1 minute", lateness: str = "1 hour") -> DataFrame:
    """Events per second in each event-time window."""
    opened = F.window("event_time", window)
    length = F.unix_timestamp(F.col("window.end")) - F.unix_timestamp(F.col("window.start"))
    if orders.isStreaming:
        orders = orders.withWatermark("event_time", lateness)
    return orders.groupBy(opened).agg(F.count(F.lit(1)).alias("events")).select(
        F.col("window.start").alias("window_start"),
        "events",
        F.round(F.col("events") / length, 4).alias("events_per_second"),
    )


def lag_seconds(orders: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Seconds between the newest event and now (or ``as_of``)."""
    now = F.current_timestamp() if as_of is None else as_of
    newest = orders.agg(F.max("event_time").alias("newest"))
    return newest.select(age_seconds(now, F.col("newest")).alias("lag_seconds"))


def total_rows(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count(F.lit(1)).alias("total_rows"))


def latest_result(
    result: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    mode: str = "complete",
) -> StreamingQuery:
    """Keep the current state of a streaming aggregate as a table at ``path``.

    Each micro-batch writes to its own folder: the whole aggregate with
    ``mode='complete'`` (for few groups; see ``read_latest``), the changed
    groups with ``'update'`` (see ``read_updates``), whose state the watermark
    keeps short.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        result.writeStream.foreachBatch(write).outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    table = spark.read.parquet(path)
    newest = table.agg(F.max("batch_id")).scalar()
    return table.filter(F.col("batch_id") == newest).drop("batch_id")


def read_updates(spark: SparkSession, path: str, *key: str) -> DataFrame:
    """The newest row of each group of an aggregate kept in update mode."""
    table = spark.read.parquet(path)
    rest = [c for c in table.columns if c not in (*key, "batch_id")]
    newest = F.max_by(F.struct(*rest), "batch_id").alias("_row")
    return table.groupBy(*key).agg(newest).select(*key, "_row.*")
