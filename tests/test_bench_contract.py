"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "scan_set"], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    b = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(b) and b["unit"] == "sec"
    assert b["sf"] == "0.001" and set(b["queries"]) == {"scan_set"}
