"""The scratch folder: only a local session may choose one itself; paths go after use."""

import os
from types import SimpleNamespace

import pytest

from fairsketch import session


def fake(master):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default),
                           sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(fake(master))


def test_scratch_paths_can_be_removed_and_nothing_else(spark):
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local)
    session.remove_path(spark, path)
    assert not os.path.exists(local)
    with pytest.raises(ValueError):
        session.remove_path(spark, "/tmp")
