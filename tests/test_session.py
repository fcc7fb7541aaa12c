"""Checkpoint-folder rules: read from the session; a private folder only in local mode."""

from __future__ import annotations

import pytest

from ipcforge.session import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):  # SparkConf / RuntimeConfig shape
        return super().get(key, default)

    def set(self, key, value):
        self[key] = value


class _Context:
    def __init__(self, master, conf=None):
        self.master = master
        self._conf = _Conf(conf or {})
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf)
        self.conf = _Conf()


def test_cluster_uses_the_configured_shared_folder():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://host:7077"))


def test_local_mode_gets_a_scratch_folder():
    s = _Session("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and s.conf.get("spark.checkpoint.dir") == d
