"""Time the headline queries and print one JSON line.

Input: $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS].
Three queries are run first to warm up the session; then every query is timed
once over its whole result, which goes to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from siltbed.plans.catalogue import QUERIES  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "route_messages",
    "accepted_messages",
    "rejected_messages",
    "message_chars",
    "partition_bounds",
    "incremental_scan",
    "batch_commit_metrics",
    "rollover_reason",
    "legacy_file_name",
    "mapper_fanout",
    "mapper_row_function",
    "mapper_transform",
    "landed_lines",
    "landed_rebalanced",
    "stream_landing",
    "committed_read",
    "text_export",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("siltbed-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "8g")
        # The local file system starts one chmod process per file; this makes that start cheaper.
        .config("spark.driver.extraJavaOptions", "-Djdk.lang.Process.launchMechanism=VFORK")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = session()
    n_events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    for name in ("route_messages", "batch_commit_metrics", "mapper_transform"):
        seconds(spark, name, SF_DIR)
    times = {name: seconds(spark, name, SF_DIR) for name in HEADLINE}
    report = {
        "metric": "total seconds of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(Path(SF_DIR).name.removeprefix("sf")),
        "messages": n_events,
        "messages_per_sec": {name: round(n_events / max(t, 1e-9)) for name, t in times.items()},
        "cpus": int(CPUS),
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
