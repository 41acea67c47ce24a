"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_QUERIES  comma list to time instead of the headline set, or ``all``

Each query runs fully: every row of every column goes to a no-op sink.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stowage import registry  # noqa: E402
from stowage.session import build_session  # noqa: E402

HEADLINE = [
    "locks_with_rse",
    "replicas_with_rse",
    "container_dataset_file",
    "replica_rse_list",
    "invalidate_containers",
    "invalidate_datasets",
    "invalidate_files",
    "last_replica_files",
    "stuck_tape_files",
    "site_block_diff",
    "block_replica_plan",
    "dark_missing_files",
    "block_chunks",
    "dm_weight",
    "dataset_summary_by_rse",
    "container_stats",
    "rule_request_decision",
    "rse_distance_matrix",
    "integrity_request_summary",
    "integrity_upsert",
    "invalidation_request_groups",
    "job_log_parse",
    "lfn_to_pfn_chain",
    "access_traces",
    "access_traces_stream",
    "payload_checksum",
    "chunk_checksum",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    queries = registry.queries()
    names = list(queries) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start the JVM, the code generator and the Python workers before timing
    queries["locks_with_rse"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{timings[name]:8.3f} {name}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
