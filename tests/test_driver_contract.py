"""The driver imports __spark_entry__ from another folder with its own
session; Python workers must still find the card parser."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
q = E.queries()
print("ROWS", q["job_cards"](spark, "/root/testdata/sf0.001").count(), E.entry(spark).count())
"""


def test_queries_run_from_another_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="hirelens-cwd-"),
                         capture_output=True, text=True, timeout=600, env=env)
    assert "ROWS 939 20" in out.stdout, out.stderr[-2000:]
