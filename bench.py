"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR picks the data (default /root/testdata/sf0.1), BENCH_CPUS the cores,
BENCH_QUERIES a comma-separated list or "all". Each query runs once to warm up and then
three times; the median counts. Rows go to Spark's no-op sink, so every column is computed
and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratalake.plans.registered import QUERIES  # noqa: E402
from stratalake.session import local_session  # noqa: E402

HEADLINE = (
    "orders_bronze", "orders_silver", "orders_latest", "kpi_orders_daily", "kpi_metric_spec",
    "entity_silver", "partition_keys", "typed_copy", "dq_report", "pk_duplicates", "fk_orphans",
    "bi_join", "seed_orders", "page_cut", "chunk_documents", "chunk_pages", "hashed_embeddings",
    "keyword_topk", "vector_topk", "hybrid_topk", "retrieval_cards", "notes", "followup_binding",
    "preference_profile", "trace_summary", "stream_dedupe",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 4)
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", cores)
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds_of_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores) if cores.isdigit() else cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
