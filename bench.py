"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS (default 3) set
the input, the cores and the number of warm runs, of which the median counts. BENCH_QUERIES may
name queries, separated by commas, or be "all".
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.queries import registry  # noqa: E402
from clickmart.session import local_session  # noqa: E402

HEADLINE = [
    "combined_events",
    "customer_360_rank",
    "customer_360_mode",
    "user_segments",
    "user_behavior",
    "product_popularity",
    "category_performance",
    "daily_performance",
    "user_journey",
    "product_affinity",
    "product_analytics",
    "brand_analytics",
    "category_recs_scored",
    "flat_recommendations",
    "refresh_daily_metrics",
    "similar_users",
    "content_based",
    "collaborative_unseen",
    "popularity_recs",
    "recommendation_summary",
    "stream_ingest",
    "history_customer_360",
    "history_product_popularity",
    "history_category_performance",
    "history_product_affinity",
    "history_category_recs",
    "history_similar_users",
]


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    queries = registry()
    names = list(queries) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE

    spark = local_session(cores)
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, directory).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:] or taken), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total_warm_median",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(directory).name.removeprefix("sf"),
        "cores": cores,
        "runs": runs,
        "spark": spark.version,
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
