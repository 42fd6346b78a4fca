"""Time the headline queries: one warm-up, then the median of three runs into a noop sink."""

from __future__ import annotations

import json
import os
import statistics
import time

from cellflow.plans.catalogue import QUERIES
from cellflow.session import session

HEADLINE = (
    "latest_cell_family", "latest_n_versions", "slice_stats", "multi_column_profile", "multi_view_scan",
    "paged_scan", "word_count", "item_pairs", "frequent_itemsets", "group_count_join", "total_count_join",
    "side_lookup_table", "upsert_latest_write", "extract_score", "lm_converged",
)


def timed(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(f"local[{cpus}]", partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in os.environ.get("BENCH_ONLY", "").split(",") if os.environ.get("BENCH_ONLY") else HEADLINE:
        timed(spark, name, folder)
        seconds[name] = round(statistics.median(timed(spark, name, folder) for _ in range(3)), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
