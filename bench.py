"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1); BENCH_CPUS: local cores (default 8).
Each query is planned and run in full, with its rows written to a sink that drops them.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.session import local_session
from workload.inputs import STORED, Inputs
from workload.registry import registered

HEADLINE = [
    "ingest_incremental",
    "global_row_number",
    "catalog_union",
    "scd2_apply",
    "view_dependency",
    "object_dependencies",
    "contains_join",
    "query_text_match",
    "query_dependencies",
    "snapshot_replace_day",
    "insert_if_absent",
    "table_space",
    "size_islands",
    "forward_fill_sizes",
    "daily_usage_join",
    "table_stats_byday",
    "data_lake_stats_byday",
    "run_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    for name in STORED:  # the stored catalogs are there before a query starts
        Inputs.over(spark, sf_dir)[name]
    queries, seconds = registered(), {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
