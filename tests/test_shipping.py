"""Queries with Python workers, started where this repository is neither the folder nor on the path."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
import __spark_entry__ as entry
queries = entry.queries()
for name in ("csv_required", "op1_sentencepiece"):
    if name in queries:
        print(name, queries[name](spark, "/root/testdata/sf0.001").count() > 0)
"""


def test_code_reaches_the_workers():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=tempfile.mkdtemp(prefix="catalink-away-"),
                         env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
    assert "csv_required True" in run.stdout and "False" not in run.stdout
