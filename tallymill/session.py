"""Session settings and the shared scratch area."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where the split of a hot key costs the grouping after the join a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# A statement's shuffle files go once it has run, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# for tables of whole lines; small ones keep Spark's codec, as file sizes tell it which to broadcast
DENSE = {"compression": "zstd"}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the statements run inside; put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The directory comes from ``spark.checkpoint.dir``. Only a session on one
    machine (tests, a laptop) may be without: it gets a temporary folder of its
    own. Elsewhere executors would each write to their own disk, so that is an
    error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root is None:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallymill-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the scratch area and return the written table.

    The rows survive the loss of any executor, and later plans start from the
    files instead of recomputing what led to them, whose shuffle files go.
    """
    path = scratch_path(df.sparkSession, label)
    with settings(df.sparkSession, FREE_SHUFFLES):
        df.write.mode("error").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
