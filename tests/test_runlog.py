"""States of runs, also of those whose driver is gone."""

import os
import signal
import subprocess
import sys
import time
from datetime import timedelta
from pathlib import Path

import pytest

from clientele.operators.runlog import Run, run_history, run_logged
from clientele.sources.audit import session_now

REPO = Path(__file__).resolve().parents[1]


def states(spark, path, **options):
    found = run_history(spark, path, ["a", "b", "c"], **options).collect()
    return sorted((r.task_name, r.status, r.rows_processed, r.error_message) for r in found)


def test_three_states(spark, tmp_path):
    path = str(tmp_path / "log")
    run_logged(spark, path, "a", 7, lambda: None)

    def broken():
        raise ValueError("no")

    with pytest.raises(ValueError):
        run_logged(spark, path, "b", 7, broken)
    run = Run(spark, path, "c")
    want = [("a", "SUCCESS", 7, None), ("b", "ERROR", None, "no"), ("c", "RUNNING", None, None)]
    assert states(spark, path) == want
    late = session_now(spark) + timedelta(hours=5)
    assert states(spark, path, hours=9, as_of=late, orphan_hours=4)[2][1] == "ORPHANED"
    run.finish(3)
    assert states(spark, path)[2] == ("c", "SUCCESS", 3, None)


def test_a_killed_driver_leaves_a_trace(spark, tmp_path):
    code = """
import sys, time
from clientele.operators.runlog import run_logged
from clientele.session import local_session
spark = local_session(1, "killed")
def work():
    print("at work", flush=True)
    time.sleep(600)
run_logged(spark, sys.argv[1], "a", 1, work)
"""
    path = str(tmp_path / "log")
    driver = subprocess.Popen(
        [sys.executable, "-c", code, path], env=os.environ | {"PYTHONPATH": str(REPO)}, stdout=subprocess.PIPE
    )
    assert b"at work" in driver.stdout.readline()
    driver.send_signal(signal.SIGKILL)
    driver.wait(60)
    time.sleep(1)
    assert [s[:2] for s in states(spark, path)] == [("a", "RUNNING")]
    assert [s[:2] for s in states(spark, path, orphan_hours=0)] == [("a", "ORPHANED")]
