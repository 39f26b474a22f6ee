"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores) and
BENCH_RUNS (default 3) steer it. Every query is first run once to warm up; the best
of the following runs counts. Results are fully computed and discarded by Spark's
noop sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "clean_listings",
    "dedup_latest",
    "silver_listings",
    "gold_listings",
    "domain_accept",
    "produced_and_failed",
    "wire_encode",
    "upsert_listings",
    "quality_checks",
    "mart_price_by_make",
    "mart_price_by_state",
    "mart_price_by_year",
    "mart_listings_summary",
    "stream_to_bronze",
    "batch_job",
]


def session(cpus: str):
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("forecourt-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(os.cpu_count() if cpus == "*" else cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="forecourt-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from forecourt.registry import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "*"))
    best = {}
    for name in HEADLINE:
        seconds(QUERIES[name], spark, sf_dir)
        best[name] = round(min(seconds(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
