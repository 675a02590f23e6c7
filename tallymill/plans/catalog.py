"""All named queries, gathered by importing the modules that register them."""

from __future__ import annotations

from tallymill.plans import (  # noqa: F401
    customer_queries,
    forecast_queries,
    profile_queries,
    quality_queries,
    sales_queries,
    star_queries,
    stream_queries,
    table_queries,
)
from tallymill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
