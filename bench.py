"""Headline timings. Prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local threads. Each query runs to
a sink that takes every row; its time is the best of ``BENCH_RUNS`` after a warm-up.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from auditlake.queries import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "4"))
HEADLINE = (
    "transform_events",
    "events_per_class",
    "incremental_range",
    "normalize_to_id",
    "lookup_coverage",
    "sorted_events",
    "page",
    "run_metrics",
    "jsonl_roundtrip",
    "lake_roundtrip",
    "one_scan_roundtrip",
    "batch_ingest",
    "stream_ingest",
)
PER_SECOND = ("transform_events", "lake_roundtrip", "one_scan_roundtrip", "batch_ingest", "stream_ingest")


def main() -> None:
    conf = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        # a folder of its own, as local runs have no shared one
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="auditlake-bench-"),
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("auditlake-bench")
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    n_events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    # the same work each round, so that a slower machine can be told from a slower query
    calibration = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        spark.range(100_000_000).selectExpr("sum(xxhash64(id))").collect()
        calibration.append(time.perf_counter() - start)
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": n_events,
                "calibration": round(min(calibration[1:] or calibration), 3),
                "events_per_sec": {name: round(n_events / seconds[name]) for name in PER_SECOND},
                "conf": {"master": f"local[{CPUS}]", **conf},
            }
        )
    )


if __name__ == "__main__":
    main()
