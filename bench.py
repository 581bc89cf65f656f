"""Benchmark: the full run from CSV, then headline queries on their own.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Prints one JSON line. `value` is the wall time of the full run (load, validate,
clean, compute, train, publish nine outputs from seven CSV tables). The raw CSV
set is written before the clock starts, and so is a warm-up of the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import functions as F

from checks import queries
from checks.adapter import Model
from shopsight.plans import pipeline
from shopsight.session import local_session
from shopsight.sources import paths
from shopsight.sources.scratch import new_path

HEADLINE = [
    "clean_orders",
    "dq_report",
    "rfm_features",
    "rfm_scores",
    "customer_full",
    "churn_features",
    "recommendations",
    "kpi_monthly",
    "cohort_wide",
    "category_analytics",
    "product_top_n",
    "sql_rfm",
    "dash_segment_matrix",
    "customer_360",
]


def write_raw(m: Model) -> str:
    """The model tables as seven CSV tables with unique row ids."""
    folder = new_path(m.spark, "bench-raw")
    for name, df in m.tables.items():
        if name in ("order_items", "inventory_items"):
            df = df.withColumn("id", F.monotonically_increasing_id())
        df.write.option("header", True).csv(paths.join(folder, f"{name}.csv"))
    return folder


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS"))
    m = Model(spark, sf_dir)
    raw = write_raw(m)
    consume(m.items.groupBy("status").count())

    seconds: dict[str, float] = {
        "full_run": timed(lambda: pipeline.run(spark, raw, new_path(spark, "bench-out"), new_path(spark, "bench-model")))
    }
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = timed(lambda: consume(queries.build(name)(spark, sf_dir)))

    print(
        json.dumps(
            {
                "metric": "full_run_wall_time",
                "value": seconds["full_run"],
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "customers": m.source("customer").count(),
                "order_items": m.source("lineitem").count(),
            }
        )
    )


if __name__ == "__main__":
    main()
