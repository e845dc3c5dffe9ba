"""Time the oracle SQL of every registered job on DuckDB (single process).

A single-node SQL-engine reference point for bench.py, since the reference
workloads publish no timings. Prints one JSON line like bench.py.
usage: python scripts/sql_baseline.py [sf_dir] [threads]
"""
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from casework.plans.oracle import SQL  # noqa: E402
from scripts.oracle_check import TABLES  # noqa: E402

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
threads = int(sys.argv[2]) if len(sys.argv) > 2 else 8
con = duckdb.connect()
con.execute(f"SET threads = {threads}")
for t in TABLES:
    p = f"{sf_dir}/{t}.parquet"
    if os.path.exists(p):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
times = {}
for name, sql in SQL.items():
    runs = []
    for _ in range(3):
        t0 = time.perf_counter()
        con.execute(sql).fetchall()
        runs.append(time.perf_counter() - t0)
    times[name] = round(statistics.median(runs), 4)
print(json.dumps({"metric": "total_query_seconds", "engine": f"duckdb {duckdb.__version__}",
                  "threads": threads, "value": round(sum(times.values()), 4), "unit": "sec",
                  "queries": times, "sf_dir": sf_dir}))
