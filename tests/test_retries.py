"""Lost tasks: jobs whose first task attempt fails give the fault-free result (subprocess, local[4,3])."""

import json
import os
import subprocess
import sys
import tempfile

from tests.conftest import ROOT, SF_SMALL


def test_failed_attempts_change_nothing():
    scratch = tempfile.mkdtemp(prefix="skewsafe-retry-")
    path = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
    out = subprocess.run([sys.executable, "-m", "tests.retry_job", SF_SMALL, scratch], cwd=ROOT,
                         capture_output=True, text=True, timeout=600, env={**os.environ, "PYTHONPATH": path})
    assert out.returncode == 0, out.stderr[-3000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["failures"] >= 2  # one injected failure per job
    assert result["salted_ok"] and result["write_ok"]
