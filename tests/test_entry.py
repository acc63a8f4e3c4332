"""The entry module is importable in a process that has no session yet."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_import_without_a_session():
    code = ("import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); "
            "assert set(s) <= set(q) and len(q) > 100; "
            "from pyspark.sql import SparkSession; assert SparkSession.getActiveSession() is None")
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
