"""The driver's entry stands without the training-data operators."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_base_queries_register_when_a_package_is_broken(tmp_path):
    (tmp_path / "ahocorasick.py").write_text("raise ImportError('no such library')")
    code = """
import __spark_entry__ as entry
from clientele.queries import registry
assert entry.queries().keys() == entry.oracle_sql().keys() == registry().keys(), sorted(entry.queries())
"""
    path = os.pathsep.join([str(tmp_path), str(REPO)])
    done = subprocess.run(
        [sys.executable, "-c", code], env=os.environ | {"PYTHONPATH": path}, cwd=tmp_path, capture_output=True, text=True
    )
    assert done.returncode == 0, done.stderr
