"""Time the named queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Each query runs ``BENCH_RUNS`` times after one
warm-up of the session; the value is the best run, results are written to the no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from saleloom.checks.queries import QUERIES

HEADLINE = (
    "clean_text_documents",
    "accent_key",
    "vocab_map",
    "cost_enrichment",
    "unified_sales",
    "duplicate_flags",
    "quality_overview",
    "scope_by_year",
    "dim_customer",
    "dim_product",
    "fact_sales",
    "mart_overview_year",
    "mart_time_month",
    "mart_channel_product",
    "mart_quarter_channel",
    "mart_pareto_customer_group",
    "ytd_kpi_yoy",
    "ytd_channel_pivot",
    "ytd_product_group",
    "outlier_summary",
    "outlier_by_group",
    "revenue_box_stats",
    "forecast_backtest",
    "forecast_vs_actual",
    "indicator_corr",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = folder.rstrip("/").rsplit("sf", 1)[-1]
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
