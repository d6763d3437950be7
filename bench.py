"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR  table folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default: all)

Each query runs once to warm up and then three times; the time given is the median.
Queries that only build a plan are run in full into Spark's no-op sink. Queries that
write or stream do that work when they are called.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from cellflux.plans.catalogue import QUERIES
from cellflux.session import build_session

HEADLINE = [
    "hourly_totals",
    "daily_totals",
    "daily_totals_lineitem",
    "tumbling_totals",
    "clean_events",
    "tsv_scan",
    "wire_decode",
    "replay_head",
    "sink_clean",
    "sink_hourly",
    "batch_job_daily",
    "stream_clean",
    "stream_hourly",
]
RUNS = 3


def once(spark: SparkSession, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "cellflux-bench",
        extra={
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="cellflux-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        once(spark, name, sf_dir)
        times[name] = round(statistics.median(once(spark, name, sf_dir) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
