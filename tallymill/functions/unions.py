"""Putting the rows of several frames together."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame


def union_rows(frames: Iterable[DataFrame]) -> DataFrame:
    """The rows of all frames, matched by column name; missing columns are NULL.

    Spark 4.1 can take a union of hash-partitioned frames for partitioned by
    the same key without putting their tasks together. Grouping such a union
    by the key then returns several rows per group (seen on a join of a union
    of per-series forecasts). The planner setting behind it is turned off in
    the session that plans the union.
    """
    first, *others = frames
    first.sparkSession.conf.set("spark.sql.unionOutputPartitioning", "false")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), others, first)
