"""Executors that can't import the package run every query and stage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

CODE = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://{shared}").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")

def gone(_):
    try:
        import slotwise
    except ModuleNotFoundError:
        return True
    return False

assert all(spark.sparkContext.parallelize(range(4), 4).map(gone).collect()), "the workers can import the package"
queries = entry.queries()
for name in sorted(x for x in queries if x == "pipeline" or x[:2] == "op" and x[2:3].isdigit()):
    assert queries[name](spark, "/root/testdata/sf0.001").count() > 0, name
    print("ok", name)
"""


def test_all_queries_travel_by_value(tmp_path):
    shared, empty = tmp_path / "shared", tmp_path / "empty"
    shared.mkdir()
    empty.mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE.format(root=ROOT, shared=shared)], cwd=empty, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0 and out.stdout.count("ok ") == 14, out.stdout[-500:] + out.stderr[-3000:]
