"""Time the headline queries; prints one JSON line.

Each query runs twice in one session and the second time counts, which is when the landing
folders that several queries share exist and the JVM has warmed up. A query that ingests
does its whole work each time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from landinglake import build_session
from landinglake.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = ("column_profile", "bulk_profile", "reject_counts", "landing_accept", "sanitize_values",
            "align_schema", "time_partitions", "partition_summary", "lake_append", "lake_dynamic",
            "bulk_write", "bulk_load", "job_params", "latest_status", "ready_jobs",
            "timeline_entities", "status_end", "step_rows", "status_fold", "incremental", "flagship")


def seconds(spark, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", {
        "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    names = sys.argv[1:] or HEADLINE
    times = {name: round([seconds(spark, name) for _ in range(RUNS)][-1], 3) for name in names}
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
