"""Operators run where the workers cannot import this package."""

from __future__ import annotations

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

JOB = """
import sys
sys.path.insert(0, {repo!r})  # of the driver alone
from wishrank.session import local_session
from wishrank.llm.queries import QUERIES
from pyspark.sql import functions as F
spark = local_session(cores=4, shuffle_partitions=4)

def seen(batches):
    import importlib.util
    import pyarrow as pa
    for batch in batches:
        yield pa.record_batch([pa.array([importlib.util.find_spec("wishrank") is not None])], names=["found"])

assert [r.found for r in spark.range(1).mapInArrow(seen, "found boolean").collect()] == [False]
for name in {names!r}:
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran")
"""


def test_workers_without_the_package(tmp_path):
    names = ["op9_ann", "op10_toxicity", "op11_whitening", "op12_turn_repair", "op13_best_fit"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", JOB.format(repo=REPO, names=names)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
