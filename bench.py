"""Benchmark: every registered query over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed completely with the no-op sink (nothing is
collected to the driver) and timed, best of $BENCH_REPEATS (default 2);
two untimed warm-up queries run first.
Prints ONE JSON line:
  {"metric": "total_query_time", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from storelens.queries import QUERIES  # noqa: E402
from storelens.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    spark = build_session(
        f"local[{cpus}]", app_name="storelens-bench", shuffle_partitions=cpus,
        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for warm in ("stg_apps", "kpis_row"):  # untimed warm-up: JVM, JIT, file listing
        run(warm)
    times: dict[str, float] = {}
    for name in (only or list(QUERIES)):
        times[name] = round(min(run(name) for _ in range(repeats)), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
