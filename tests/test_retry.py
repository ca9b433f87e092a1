"""Results survive task failures (retried attempts give the same rows)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from .conftest import SF_SMALL


def test_retried_tasks_give_identical_results():
    probe = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_probe.py")
    done = subprocess.run([sys.executable, probe, SF_SMALL], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    result = json.loads(done.stdout.strip().splitlines()[-1])
    assert result.pop("injected_failures") >= 3  # at least one failed attempt per disturbed run
    for name, (rows, same) in result.items():
        assert rows > 0 and same, name
