"""Headline-query timings at one scale factor; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is fully evaluated into the no-op sink (no driver collection).
A first pass over all queries is reported as ``cold`` (JIT, code generation,
first file listing); ``queries`` holds each query's best time over the
following warm passes.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from intake_spark.plans.registry import QUERIES  # noqa: E402
from intake_spark.session import get_session  # noqa: E402

WARM_PASSES = 2
HEADLINE = [
    "stable_candidates", "latest_snapshot", "scan_counts", "include_match", "ignore_filter",
    "dir_size_rollup", "last_wins_listing", "unprocessed", "still_exists", "best_artifact",
    "job_outcomes", "job_timeline", "queue_position", "delivery_manifest", "job_metadata",
    "stream_stability",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g"})
    cold, warm = {}, {}
    for rnd in range(1 + WARM_PASSES):
        for name in HEADLINE:
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            t = round(time.perf_counter() - t0, 3)
            if rnd == 0:
                cold[name] = t
            else:
                warm[name] = min(t, warm.get(name, t))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "cold": cold, "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus, "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
