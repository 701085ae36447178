"""The driver's contract, also from another folder and without the package on the workers' path."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata/sf0.001")

PROGRAM = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
queries = e.queries()
print("ROWS", e.entry(spark).count(), queries["p4_found"](spark, {str(DATA)!r}).count(), queries["p6_found"](spark, {str(DATA)!r}).count())
"""


def test_names_agree():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {f"p{n}_found" for n in (1, 2, 4, 5, 6, 7)} <= set(e.queries())


@pytest.mark.skipif(not DATA.exists(), reason="needs the test data")
def test_workers_get_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", PROGRAM], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "ROWS" in done.stdout, done.stderr[-2000:]
    assert all(int(n) > 0 for n in done.stdout.split("ROWS")[1].split()[:3])
