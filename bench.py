"""Headline queries, timed: one JSON line on standard output.

Each query runs once to warm up and then ``BENCH_RUNS`` times; the median counts. Results
go to a sink that computes every row and column and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "staged_events", "staged_orders", "staged_documents", "latest_change_per_line",
    "latest_change_per_user", "typed_projection", "merge_by_key", "merge_into_months",
    "month_partitions", "unique_test", "test_report", "source_freshness", "monitored_metrics",
    "snapshot_by_check", "raw_dictionary", "typed_source_tables", "landing_format_chain",
    "task_totals", "drop_plan", "config_override", "orphaned_access",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from workload import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus), "runs": runs,
    }))


if __name__ == "__main__":
    main()
