"""Scratch location: taken from the session, set locally only when the cluster names none."""

import pytest

from tallyspark import session


def test_scratch_uses_session_checkpoint_dir(spark):
    base = session.ensure_checkpoint_dir(spark)
    assert base
    assert session.scratch_dir(spark, "x").startswith(base.rstrip("/") + "/tables/x-")


class Conf:
    def get(self, key, default=None):
        return default


class Context:
    def __init__(self, master):
        self.master, self.dir = master, None

    def getConf(self):
        return Conf()

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d


class FakeSpark:
    conf = Conf()

    def __init__(self, master):
        self.sparkContext = Context(master)


def test_unset_checkpoint_dir_falls_back_without_modifying_conf():
    fake = FakeSpark("local[4]")
    d = session.ensure_checkpoint_dir(fake)
    assert d and fake.sparkContext.dir == d
    assert session.ensure_checkpoint_dir(fake) == d          # stable afterwards


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_a_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(FakeSpark(master))
