import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(f"{SF}/events.parquet"), reason="test tables absent")
def test_failed_tasks_are_retried_to_the_same_result():
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "retry_job.py")
    out = subprocess.run([sys.executable, script, SF], capture_output=True, text=True, timeout=600)
    line = [l for l in out.stdout.splitlines() if l.startswith("{")]
    assert line, out.stderr[-2000:]
    result = json.loads(line[-1])
    assert result == {"clean": 129, "retried": 129, "failed_attempts": True, "equal": True}
