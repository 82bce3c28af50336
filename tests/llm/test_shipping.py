"""Every operator runs where workers cannot import the package."""

import os
import subprocess
import sys

from contractloom.llm.queries import QUERIES

SCRIPT = """
import os, sys, tempfile
repo, sf = sys.argv[1:3]
assert "PYTHONPATH" not in os.environ
sys.path.insert(0, repo)  # of the driver alone
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
         .config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", tempfile.mkdtemp()).getOrCreate())
spark.sparkContext.setLogLevel("OFF")

def importable(_):
    import importlib.util
    yield importlib.util.find_spec("contractloom") is not None

assert not any(spark.sparkContext.parallelize([1], 1).mapPartitions(importable).collect())
from contractloom.llm.queries import QUERIES
from contractloom.workloads.queries import QUERIES as CORE
for name in QUERIES:
    print(name, QUERIES[name](spark, sf).count(), flush=True)
for name in ("validate_documents", "sink_packed_documents"):
    print(name, CORE[name](spark, sf).count(), flush=True)
"""


def test_all_operators_without_the_package_on_the_workers(sf, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    done = subprocess.run([sys.executable, "-c", SCRIPT, repo, sf], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1200)
    assert done.returncode == 0, done.stderr[-3000:]
    assert [line.split()[0] for line in done.stdout.splitlines() if line.startswith("op")] == list(QUERIES)
