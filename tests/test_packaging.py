"""Python workers find the package even where only the driver has the repository on its path."""

import os
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

CODE = f"""
import sys
sys.path.insert(0, {REPO!r})
import __spark_entry__ as registered
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate())
print("rows", registered.queries()["item_verdict"](spark, {SF!r}).count(), registered.queries()["payload_batches"](spark, {SF!r}).count())
spark.stop()
"""


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_queries_with_python_parts_run_from_a_foreign_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 1500 1500" in done.stdout, done.stderr[-2000:]
