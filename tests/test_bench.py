"""The bench ends, and prints one line."""

from __future__ import annotations

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_its_figures():
    environment = os.environ | {
        "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "2",
        "BENCH_ONLY": "category_stats,fit_linear",
    }
    done = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], env=environment, cwd=ROOT,
        capture_output=True, text=True, timeout=900,
    )
    assert done.returncode == 0, done.stderr[-2000:]
    found = json.loads(done.stdout.strip().splitlines()[-1])
    timed = {"category_stats", "fit_linear", "prepare_baseline", "prepare", "score_saved_tree"}
    assert set(found["queries"]) == timed and found["unit"] == "sec" and found["sf"] == "0.001"
    assert found["value"] == round(sum(found["queries"].values()), 3)
