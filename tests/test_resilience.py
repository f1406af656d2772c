"""A failed task attempt during a store write leaves no duplicate or missing records."""

import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))


def test_store_write_survives_task_failure(tmp_path):
    out = subprocess.run(
        [sys.executable, os.path.join(HERE, "resilience_job.py"), str(tmp_path / "store")],
        capture_output=True, text=True, timeout=600,
    )
    lines = [line for line in out.stdout.splitlines() if line.startswith("RESULT")]
    assert lines, out.stdout[-2000:] + out.stderr[-3000:]
    observed, stored, distinct, expected = map(int, lines[0].split()[1:])
    assert os.path.exists(str(tmp_path / "store") + ".injected"), "the fault was not injected"
    assert observed == stored == distinct == expected
