"""bench.py prints one JSON line with the expected fields."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    data = json.loads(lines[0])
    assert data["unit"] == "sec" and data["sf"] == 0.001
    assert "errors" not in data
    assert data["value"] > 0 and "page_performance" in data["queries"] and "bronze_to_gold_run" in data["queries"]
