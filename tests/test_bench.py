"""bench.py runs end to end and prints one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=1200, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    r = json.loads(lines[0])
    assert r["metric"] == "total_query_time" and r["unit"] == "sec"
    assert r["sf"] == 0.001 and r["value"] > 0
    assert set(r["queries"]) >= {"gold_fingerprints", "match_momentum", "run_pipeline"}
