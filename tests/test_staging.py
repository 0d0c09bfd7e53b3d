"""What stays in the shared folder: nothing of failed writes, nothing of runs that ended or died."""

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from terrasieve.functions import staging
from terrasieve.operators import selection as C


def held(spark):
    return sorted(os.listdir(staging.run_dir(spark).removeprefix("file:")))


def test_failed_writes_leave_nothing(spark):
    before = held(spark)
    bad = spark.range(100).repartition(4).withColumn("x", F.when(F.col("id") == 71, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        staging.stage(bad, "bad")
    assert held(spark) == before
    good = staging.stage(spark.range(10), "good")
    assert len(held(spark)) == len(before) + 1 and good.count() == 10
    staging.drop(good)
    assert held(spark) == before


def test_sweep_takes_old_runs_of_others(spark):
    top = os.path.dirname(staging.run_dir(spark).removeprefix("file:"))
    for name, hours in (("run-dead", 100), ("run-busy", 1), ("other", 100)):
        os.makedirs(f"{top}/{name}/table")
        at = time.time() - 3600 * hours
        os.utime(f"{top}/{name}", (at, at))
    mine = staging.run_dir(spark)
    os.utime(mine.removeprefix("file:"), (0, 0))
    assert [os.path.basename(p) for p in staging.sweep(spark)] == ["run-dead"]
    assert os.path.isdir(mine.removeprefix("file:")) and sorted(n for n in os.listdir(top) if n in ("run-dead", "run-busy", "other")) == ["other", "run-busy"]


ENDING = """
import sys
from pyspark.sql import SparkSession, functions as F
from terrasieve.functions import staging
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
staging.stage(spark.range(5), "kept")
spark.range(5).write.parquet(staging.new_path(spark, "store"))
print("HELD", len(__import__("os").listdir(staging.run_dir(spark).removeprefix("file:"))))
staging.stage(spark.range(5).select(F.raise_error(F.lit("stop"))), "failed")
"""


def test_an_ended_driver_leaves_nothing(tmp_path):
    done = subprocess.run([sys.executable, "-c", ENDING, str(tmp_path)], capture_output=True, text=True, timeout=120)
    assert done.returncode and "HELD 2" in done.stdout and "stop" in done.stderr
    for _ in range(40):  # the JVM ends after its driver
        if not os.listdir(tmp_path / "terrasieve"):
            break
        time.sleep(0.5)
    assert os.listdir(tmp_path / "terrasieve") == []


def test_order_of_one_hot_key(spark):
    """Rows of one key are parted by ranges too; ranks have no gap."""
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("path")).repartition(5)
    got = C.in_order(rows, "path").collect()
    assert sorted(r.z_order for r in got) == list(range(3000)) and got[0].asDict().keys() == {"path", "z_order"}
    assert [r.path for r in sorted(got, key=lambda r: r.z_order)] == sorted(r.path for r in got)
