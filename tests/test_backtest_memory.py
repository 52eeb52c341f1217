"""The whole backtest with a small driver."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
RUN = """
import sys
from pyspark.sql import SparkSession
import __spark_entry__
at = sys.argv[1]
spark = SparkSession.builder.master("local[2]").config("spark.driver.memory", "1g").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", f"file://{at}/shared").config("spark.sql.warehouse.dir", at).getOrCreate()
assert __spark_entry__.entry(spark).count() > 0
"""


def test_entry_with_one_gigabyte_of_heap(tmp_path):
    done = subprocess.run([sys.executable, "-c", RUN, str(tmp_path)], cwd=ROOT, env={**os.environ, "PYTHONPATH": str(ROOT)}, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
