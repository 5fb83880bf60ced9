"""Every operator with Python workers that can't import the library."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SCRIPT = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[2]).getOrCreate()
spark.sparkContext.setLogLevel("ERROR")


def importable(batches):
    try:
        import roadpulse
        found = True
    except ImportError:
        found = False
    for b in batches:
        yield b.append_column("found", __import__("pyarrow").array([found] * b.num_rows))


assert {r.found for r in spark.range(4).mapInArrow(importable, "id long, found boolean").collect()} == {False}
sys.path.insert(0, sys.argv[1])
from roadpulse.llm import queries

for name, query in queries.QUERIES.items():
    assert query(spark, "/root/testdata/sf0.001").count() > 0, name
print("all done")
"""


def test_workers_outside_the_repository(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, ROOT, f"file://{tmp_path}"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "all done" in out.stdout, out.stderr[-3000:]
