"""Times the headline queries on one machine and prints one JSON line.

Each query is planned and run to completion (its rows go nowhere) once to warm
up and then several times; the median counts, plan building included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.session import local_session  # noqa: E402
from tidemark.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "reconciled_snapshot",
    "customer_master",
    "review_partners",
    "key_parity",
    "table_digest",
    "incremental_extract",
    "latest_per_key",
    "upsert_snapshot",
    "apply_change_set",
    "customer_alias",
    "cards_master",
    "orphan_transactions",
    "order_breaks",
    "generated_transactions",
    "sync_metrics",
    "dq_suite",
    "published_state",
)
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def run_once(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.mkdtemp(prefix="tidemark-bench-")
    spark = local_session(cpus, app="tidemark-bench", **{"spark.checkpoint.dir": folder})
    times = {}
    for name in HEADLINE:
        run_once(spark, name, sf_dir)
        times[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(REPEATS)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_seconds",
                "value": round(sum(times.values()), 4),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
