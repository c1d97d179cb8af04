"""Checkpoint-folder policy: use the session's setting; create a local folder
only for local masters."""

import pytest

from panelgap.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, d):
        self.d = d

    def get(self, k, default=None):
        return self.d.get(k, default)


class _SC:
    def __init__(self, master, current=None):
        self.master, self.current = master, current

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, d):
        self.current = d


class _Spark:
    def __init__(self, master, conf=None, current=None):
        self.sparkContext = _SC(master, current)
        self.conf = _Conf(conf or {})


def test_cluster_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark("yarn"))


def test_cluster_uses_the_configured_shared_folder():
    s = _Spark("yarn", {"spark.checkpoint.dir": "hdfs://shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs://shared/ckpt"


def test_existing_checkpoint_dir_is_kept():
    assert ensure_checkpoint_dir(_Spark("yarn", current="s3://bucket/x")) == "s3://bucket/x"


def test_local_master_gets_a_scratch_folder():
    d = ensure_checkpoint_dir(_Spark("local[2]"))
    assert d and "panelgap-ckpt-" in d
