"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="2",
               BENCH_QUERIES="heading_directory_profile,flagship_scaled", BENCH_DRIVER_MEMORY="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    line = json.loads(out[0])
    assert line["unit"] == "sec" and line["sf"] == 0.001 and line["metric"] == "total_job_seconds"
    assert set(line["queries"]) == {"heading_directory_profile", "flagship_x2"}
    assert line["value"] > 0 and "errors" not in line
