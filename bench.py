"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Each query runs
once to warm up, then ``BENCH_RUNS`` times; the median counts. The entry table that a
deployment already has is written once before and timed on its own.
"""

from __future__ import annotations

import json
import os
import statistics
import time

HEADLINES = [
    "enqueue_changed", "enqueue_deletes", "job_insert_ignore", "seen_merge", "supersede_pending", "claim_batch",
    "stale_vs_seen", "item_build", "item_refs", "enrich_union", "chunk_documents", "embed_chunks", "payload_typed",
    "upsert_replace", "search_topk", "search_many", "sync_entries",
]


def main() -> None:
    from tidemark.plans.catalog import QUERIES
    from tidemark.session import build_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        f"local[{cpus}]", "tidemark-bench",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    landing = timed("item_hash")
    seconds = {}
    for name in HEADLINES:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "landing": round(landing, 3), "sf": folder.rsplit("sf", 1)[-1], "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
