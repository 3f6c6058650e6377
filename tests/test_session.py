import re
import subprocess
import sys
from types import SimpleNamespace

import pytest
from pyspark.sql import SparkSession

from flightlake import session


def test_no_master_or_partitions_are_forced(monkeypatch):
    set_ = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, m):
            set_["spark.master"] = m
            return self

        def config(self, k, v):
            set_[k] = v
            return self

        def getOrCreate(self):
            return SimpleNamespace(sparkContext=SimpleNamespace(setLogLevel=lambda level: None))

    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    session.build_session()
    assert not {"spark.master", "spark.sql.shuffle.partitions", "spark.driver.memory"} & set(set_)
    set_.clear()
    session.build_session("local[3]")
    assert set_["spark.master"] == "local[3]" and set_["spark.sql.shuffle.partitions"] == "3"


def _fake(master, folder):
    seen = {}
    sc = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda k, d=None: folder), getCheckpointDir=lambda: seen.get("dir"),
                         setCheckpointDir=lambda d: seen.update(dir=d))
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: folder)), seen


def test_a_cluster_needs_a_shared_folder():
    spark, _ = _fake("spark://host:7077", None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(spark)
    spark, seen = _fake("spark://host:7077", "hdfs://nn/tmp/x/")
    assert session.shared_root(spark) == "hdfs://nn/tmp/x" and seen["dir"] == "hdfs://nn/tmp/x/"
    spark, _ = _fake("local-cluster[2,1,1024]", None)
    with pytest.raises(RuntimeError):
        session.shared_root(spark)
    spark, _ = _fake("local[2]", None)
    assert re.search("flightlake-ckpt-", session.shared_root(spark))


def test_command_line_help_names_no_master():
    out = subprocess.run([sys.executable, "-m", "flightlake", "--help"], capture_output=True, text=True, timeout=120,
                         cwd=str(__import__("pathlib").Path(__file__).parents[1]))
    assert out.returncode == 0 and "spark-submit" in out.stdout


def test_cluster_settings_follow_the_input():
    small, large = session.cluster_conf(10**9, 16), session.cluster_conf(10**14, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 32 and int(large["spark.sql.shuffle.partitions"]) > 700_000


def test_sessions_are_spark_sessions(spark):
    assert isinstance(spark, SparkSession) and session.shared_path(spark, "x") != session.shared_path(spark, "x")
