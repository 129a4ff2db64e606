"""Workers that have no copy of this package: Spark is started from another
folder, and only the driver's own path has the repository."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = f"""
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", sys.argv[1]).getOrCreate())
def missing(_):
    import importlib.util
    yield importlib.util.find_spec("topicgraph") is None
assert spark.sparkContext.parallelize([0], 1).mapPartitions(missing).collect() == [True]
sys.path.insert(0, {REPO!r})
import __spark_entry__ as entry
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, query(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_all_queries(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path / "ckpt")], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, run.stderr[-3000:]
    assert {line.split()[0].split("_")[0] for line in run.stdout.splitlines()} >= {f"op{n}" for n in range(1, 14)} | {"pipeline"}
