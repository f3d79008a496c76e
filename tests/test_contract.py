"""Driver contract: bench.py prints exactly one JSON line with the required
fields; the entry module exposes entry / queries / oracle_sql."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_WARMUPS="0", BENCH_ONLY="session_stats", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd="/tmp",
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == "0.001" and "session_stats" in d["queries"]
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6


def test_entry_module_surface():
    import __spark_entry__ as E
    from clickscope.plans.registry import QUERIES
    assert callable(E.entry)
    qs, sql = E.queries(), E.oracle_sql()
    assert len(QUERIES) >= 51 and set(QUERIES) <= set(sql) <= set(qs)
