"""The driver imports __spark_entry__ from its own working directory with a default session:
Python workers must still find the package (shipped with addPyFile) and the archive reader
must work without the filter-pushdown setting."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {os.path.join(ROOT, "__spark_entry__.py")!r})
entry = importlib.util.module_from_spec(spec); spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("ENTRY", entry.entry(spark).count())
print("ARCHIVE", entry.queries()["archive_roundtrip"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_entry_from_another_directory(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ENTRY 40" in out.stdout and "ARCHIVE 40" in out.stdout, out.stderr[-2000:]
