"""The driver may import __spark_entry__ by path from any directory; the
package must then still import on the driver and in Python tasks."""

import os
import subprocess
import sys
import tempfile

SCRIPT = r"""
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {entry!r})
E = importlib.util.module_from_spec(spec)
spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
print("ROWS", E.queries()["employee_records"](spark, "/root/testdata/sf0.001").count())
print("ENTRY", E.entry(spark).count())
spark.stop()
"""


def test_entry_from_another_directory():
    entry = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    cwd = tempfile.mkdtemp(prefix="entry-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(entry=entry)], cwd=cwd, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = dict(line.split() for line in out.stdout.splitlines() if line.startswith(("ROWS", "ENTRY")))
    assert int(lines["ROWS"]) == 150
    assert int(lines["ENTRY"]) > 0
