"""Where intermediate tables go."""

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from cartwise.session import DROP_SHUFFLES, clear_scratch, materialise, ready, scratch_dir, shared_dir


def session(master, configured=None, current=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=lambda path: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_shared_folder():
    assert shared_dir(session("yarn", configured="hdfs:///work/")) == "hdfs:///work"
    assert shared_dir(session("yarn", current="hdfs:///set")) == "hdfs:///set"
    for master in ("yarn", "local[2]"):
        with pytest.raises(RuntimeError):
            shared_dir(session(master))


def test_only_local_sessions_get_a_folder_of_their_own():
    given = []
    for master, configured in (("local[2]", None), ("yarn", None), ("local[2]", "/work")):
        own = session(master, configured)
        own.sparkContext.setCheckpointDir = given.append
        assert ready(own) is own
    assert len(given) == 1 and "cartwise-" in given[0]


def test_materialise_cuts_the_lineage_and_can_be_cleared(spark):
    stored = materialise(spark.range(5).withColumnRenamed("id", "n"), "numbers")
    assert scratch_dir(spark) in stored.inputFiles()[0]
    assert stored.selectExpr("sum(n)").first()[0] == 10
    assert clear_scratch(spark) and not clear_scratch(spark)


def test_shuffles_of_a_written_table_go_with_its_job(spark):
    folders = Path(spark.sparkContext._temp_dir).parent.parent  # Spark's own folder lies beside those of its blocks

    def shuffles():
        return set(folders.glob("blockmgr-*/*/shuffle_*.data"))

    before, setting = shuffles(), spark.conf.get(DROP_SHUFFLES)
    stored = materialise(spark.range(100_000).groupBy(F.col("id") % 50_000).count(), "counted")
    for _ in range(50):
        left = shuffles() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(DROP_SHUFFLES) == setting
    counted = spark.range(1000).groupBy(F.col("id") % 500).count()
    assert len(counted.collect()) == len(counted.collect()) == 500 and shuffles() - before  # a job of the user's keeps its own
    assert stored.count() == 50_000
