"""Shared folder and package shipping, whatever the file system."""

import types

import pytest

from capstan import session


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Context:
    applicationId = "app-fake"

    def __init__(self, master):
        self.master, self.dir, self.sent = master, None, []

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def addPyFile(self, f):
        self.sent.append(f)


def _spark(master, **conf):
    return types.SimpleNamespace(sparkContext=_Context(master), conf=_Conf(conf))


def test_remote_checkpoint_folder_starts():
    s = _spark("yarn", **{"spark.checkpoint.dir": "hdfs://nn:8020/ckpt"})
    assert session.ensure_checkpoint_dir(s) == "hdfs://nn:8020/ckpt"
    assert session.scratch_path(s, "x").startswith("hdfs://nn:8020/ckpt/capstan/x-")
    session._SHIPPED.discard("app-fake")
    session.ship_package(s)
    session.ship_package(s)
    session._SHIPPED.discard("app-fake")
    assert len(s.sparkContext.sent) == 1 and s.sparkContext.sent[0].endswith(".zip")


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,512]"])
def test_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_spark(master))


def test_local_master_gets_a_private_folder():
    s = _spark("local[2]")
    assert session.ensure_checkpoint_dir(s) == s.conf["spark.checkpoint.dir"] == s.sparkContext.dir
