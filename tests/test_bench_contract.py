"""bench.py prints one JSON line with the fields the driver records."""
import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="appeals_by_status,member_count")
    out = subprocess.run([sys.executable, f"{ROOT}/bench.py"], env=env, capture_output=True, text=True,
                         timeout=600, cwd="/tmp")
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout + out.stderr[-2000:]
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == "0.001" and set(d["queries"]) == {"appeals_by_status", "member_count"}
    assert all(isinstance(v, float) for v in d["queries"].values()) and d["failed"] == []
