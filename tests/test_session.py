"""Intermediates go to a shared folder; a missing one is an error on a cluster."""

import os
from types import SimpleNamespace

import pytest

from voltframe import session


def stub(master):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda folder: None)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(stub(master))


def test_a_local_master_gets_a_temporary_folder():
    for master in ("local", "local[8]", "local[*]"):
        assert os.path.isdir(session.ensure_checkpoint_dir(stub(master)))


def test_cleanup_removes_what_was_written(spark):
    before = len(session.WRITTEN)
    kept = session.written(spark.range(5).toDF("a"), "numbers")
    assert kept.count() == 5
    folder = session.WRITTEN[-1].removeprefix("file:")
    assert os.path.isdir(folder)
    assert session.cleanup(spark, since=before) == 1
    assert not os.path.exists(folder)
