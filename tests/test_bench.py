"""bench.py contract: exactly one JSON line on stdout with the required keys."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF0001


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_REPEATS="1", BENCH_CPUS="2",
               BENCH_DRIVER_MEMORY="1g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert abs(result["value"] - sum(
        t for name, t in result["queries"].items() if not name.endswith("_subscribers"))) < 0.01
