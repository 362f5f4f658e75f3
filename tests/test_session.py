from types import SimpleNamespace

import pytest

from fairwait.session import shared_path, shared_root


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, configured=None, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: configured if key == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master, folder))


def test_the_configured_folder_is_used():
    spark = session("yarn", "hdfs://shared/checkpoints")
    assert shared_root(spark) == "hdfs://shared/checkpoints"
    assert spark.sparkContext.folder == "hdfs://shared/checkpoints"


def test_the_configured_folder_is_set_once():
    spark, given = session("yarn", "/shared"), []
    spark.sparkContext.setCheckpointDir = given.append
    assert [shared_root(spark) for _ in range(3)] == ["/shared"] * 3 and given == ["/shared"]


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(session("yarn"))


def test_a_local_session_keeps_one_folder():
    spark = session("local[2]")
    assert shared_root(spark) == shared_root(spark) == spark.sparkContext.folder


def test_paths_are_fresh(spark):
    assert shared_path(spark, "a") != shared_path(spark, "a")

