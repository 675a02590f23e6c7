"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of source tables, BENCH_CPUS the local threads.
Every query runs to the end over its whole tables; its rows go to a sink that
drops them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tallymill.plans.catalog import QUERIES
from tallymill.session import build_session

HEADLINE = (
    "batch_build",
    "fact_build",
    "monthly_revenue",
    "revenue_by_category",
    "revenue_by_region",
    "top_products",
    "executive_kpi",
    "mart_executive_kpis",
    "customer_rfm",
    "mart_customer_intelligence",
    "customer_segments",
    "kpi_customer_pareto",
    "kpi_discount_sensitivity",
    "forecast_ets",
    "sales_forecast_baselines",
    "dq_not_null",
    "dq_unique",
    "profile_numeric",
    "profile_columns",
    "stream_validate",
    "stream_dedup",
    "stream_category_kpis",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
