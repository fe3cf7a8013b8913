"""Seconds per headline query: median of warm runs, results discarded after full evaluation.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from martweave.queries import QUERIES
from martweave.session import build_session, scratch_scope

HEADLINE = [
    "merged_mart",
    "mart_refresh",
    "conform_orders",
    "upsert_orders",
    "upsert_latest",
    "action_list",
    "merge_extracts",
    "fk_orphans",
    "partition_upsert",
    "staged_publish",
    "row_diff",
    "row_diff_repeated_keys",
    "table_checksum",
    "schema_diff",
    "catalog_listing",
    "row_counts",
    "row_index",
    "chunk_ids",
    "dispatch_order",
    "top5_per_stage",
    "class_gate",
    "stage_latest",
    "csv_roundtrip",
    "orc_partitioned",
    "dyn_overwrite",
    "json_config",
    "run_summary",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "martweave-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            with scratch_scope(spark):
                start = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
