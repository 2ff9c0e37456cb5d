"""The shared folder for staging and checkpoints comes from the session."""

import pytest

from tabflow import session as S


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _Context:
    def __init__(self, master, checkpoint=None):
        self.master = master
        self._checkpoint = checkpoint

    def getCheckpointDir(self):
        return self._checkpoint

    def setCheckpointDir(self, path):
        self._checkpoint = path


class _Session:
    def __init__(self, master, conf=None, checkpoint=None):
        self.conf = _Conf(conf or {})
        self.sparkContext = _Context(master, checkpoint)


def test_uses_the_configured_folder():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"})
    assert S.shared_dir(s) == "hdfs://nn/shared/ckpt"
    assert s.sparkContext.getCheckpointDir() == "hdfs://nn/shared/ckpt/"


def test_refuses_a_local_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.shared_dir(_Session("yarn"))


def test_local_mode_gets_a_scratch_folder():
    s = _Session("local[2]")
    path = S.shared_dir(s)
    assert path and s.sparkContext.getCheckpointDir() == path


def test_real_session_reports_its_folder(spark):
    assert S.shared_dir(spark)
