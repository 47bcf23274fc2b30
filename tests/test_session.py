import time

import pytest
from pyspark.sql import functions as F

from basketry import session


class Conf:
    def get(self, key, default=None):
        return default


class Context:
    master = "yarn"

    def getCheckpointDir(self):
        return None


class Session:
    conf, sparkContext = Conf(), Context()


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_package_is_shipped_once(spark):
    session.ship_package(spark)
    before = len(spark.sparkContext._python_includes)
    session.ship_package(spark)
    assert len(spark.sparkContext._python_includes) == before
    assert any(f.startswith("basketry") for f in spark.sparkContext._python_includes)


def test_scratch_is_dropped(spark):
    rows = session.materialise(spark.range(5), "five")
    path = spark.sparkContext._basketry_scratch[-1]
    assert rows.count() == 5 and "/basketry/five-" in path
    assert session.drop_scratch(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_scopes_know_their_own_paths(spark):
    outer = session.scratch_path(spark, "outer")
    with session.scratch_scope() as first:
        a = session.scratch_path(spark, "a")
        with session.scratch_scope() as second:
            b = session.scratch_path(spark, "b")
            spark.range(3).write.parquet(b)
    assert first == [a, b] and second == [b]
    session.drop_paths(spark, second)
    assert b not in session.scratch_paths(spark) and outer in session.scratch_paths(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(b)


def test_shuffles_go_with_their_query(spark, tmp_path):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def data_files():
        return {f for f in disk.getAllFiles().mkString("\n").split("\n")
                if "/shuffle_" in f and f.endswith(".data")}

    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, setting = data_files(), spark.conf.get(session._CLEANUP, None)
    with session.shuffles_dropped(spark):
        with session.shuffles_dropped(spark):
            pass
        rows.write.parquet(str(tmp_path / "a"))
        until = time.time() + 20
        while data_files() - before and time.time() < until:
            time.sleep(0.2)
        assert not data_files() - before
    assert spark.conf.get(session._CLEANUP, None) == setting
    assert spark.read.parquet(str(tmp_path / "a")).count() == 7
