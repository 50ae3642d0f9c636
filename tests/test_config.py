"""Scratch/checkpoint folder rule and session settings."""

import os

from fragstat.config import checkpoint_root, local_cores, scratch_path, session_settings


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    master = "local[2]"

    def __init__(self, checkpoint_dir=None):
        self.dir = checkpoint_dir
        self.set_to = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.set_to = path
        self.dir = path


class _Session:
    def __init__(self, conf, context):
        self.conf = _Conf(conf)
        self.sparkContext = context


def test_cluster_setting_is_used_and_never_replaced():
    ctx = _Context()
    spark = _Session({"spark.checkpoint.dir": "hdfs://shared/checkpoints/"}, ctx)
    assert checkpoint_root(spark) == "hdfs://shared/checkpoints"
    assert ctx.set_to is None
    assert scratch_path(spark, "tables", "x", unique=False) == "hdfs://shared/checkpoints/fragstat/tables/x"


def test_context_checkpoint_dir_is_used_next():
    ctx = _Context("file:/shared/ck/abc")
    assert checkpoint_root(_Session({}, ctx)) == "file:/shared/ck/abc"
    assert ctx.set_to is None


def test_private_folder_only_when_unset():
    ctx = _Context()
    root = checkpoint_root(_Session({}, ctx))
    assert ctx.set_to == root and os.path.isdir(root)
    a, b = scratch_path(_Session({}, ctx), "m"), scratch_path(_Session({}, ctx), "m")
    assert a != b and a.startswith(root)


def test_shuffle_partitions_only_for_known_cores():
    assert "spark.sql.shuffle.partitions" not in session_settings(None)
    assert session_settings(4)["spark.sql.shuffle.partitions"] == "8"
    assert local_cores("local[3]") == 3 and local_cores("local") == 1
    assert local_cores("spark://host:7077") is None


def test_no_private_folder_on_a_cluster():
    import pytest

    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        ctx = _Context()
        ctx.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(_Session({}, ctx))
        assert ctx.set_to is None
