"""Time the oracle SQL in DuckDB (the warehouse engine the source project
runs its models on) over the same parquet folder, one query at a time,
materialising each result as an Arrow table.

usage: python tools/duckdb_baseline.py [sf_dir] [threads]
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402

from oracle_sql import ORACLE  # noqa: E402


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    threads = int(argv[1]) if len(argv) > 1 else 8
    con = duckdb.connect()
    con.execute(f"SET threads = {threads}")
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    times = {}
    for name, sql in ORACLE.items():
        best = None
        for _ in range(2):
            t0 = time.perf_counter()
            con.sql(sql).to_arrow_table()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    print(json.dumps({"engine": f"duckdb {duckdb.__version__}", "threads": threads,
                      "value": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    main(sys.argv[1:])
