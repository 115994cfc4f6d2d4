"""The executors get the package wherever Spark was started."""

from __future__ import annotations

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from __spark_entry__ import queries
print("rows", queries()["html_elements"](spark, "/root/testdata/sf0.001").count())
"""


def test_a_query_runs_from_an_empty_folder(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH",)}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=240
    )
    assert done.returncode == 0, done.stderr[-2000:]
    assert int(done.stdout.rpartition("rows ")[2]) > 0
