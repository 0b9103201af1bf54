"""Time every registered query; print one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local threads), BENCH_RUNS (timed runs
per query after one warm-up; the median counts), BENCH_QUERIES (comma-separated subset).
Each run includes planning and computes all columns of all rows (no-op sink).
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from turnloom.session import local_session
from turnloom.workload.queries import QUERIES


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    spark = local_session(cpus, "bench")
    seconds = {}
    for name in chosen:
        timed(QUERIES[name], spark, sf_dir)
        seconds[name] = round(
            statistics.median(timed(QUERIES[name], spark, sf_dir) for _ in range(runs)), 3
        )
    spark.stop()
    scale = Path(sf_dir).name.removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "sum of median warm query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
