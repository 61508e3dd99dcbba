"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF0001


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF0001, BENCH_QUERIES="matvec,word_count", BENCH_REPS="1",
               BENCH_WARMUP="0", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, out.stdout
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and set(rec["queries"]) == {"matvec", "word_count"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-3
