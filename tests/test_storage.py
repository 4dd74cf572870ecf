from types import SimpleNamespace

import pytest

from firstpour import storage


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": folder}.get(key) or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_is_where_the_cluster_says():
    made = storage.scratch(session("spark://host:7077", "hdfs:///shared/"), "x")
    assert made.startswith("hdfs:///shared/x-")
    assert made != storage.scratch(session("spark://host:7077", "hdfs:///shared/"), "x")


def test_only_a_local_session_may_use_a_temporary_folder():
    assert "firstpour-" in storage.scratch(session("local[2]"), "x")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            storage.scratch(session(master), "x")


def test_folders(spark, root):
    storage.make_dirs(spark, f"{root}/b/_hidden")
    storage.make_dirs(spark, f"{root}/b/y")
    storage.make_dirs(spark, f"{root}/b/x")
    assert storage.children(spark, f"{root}/b") == ["x", "y"]
    assert storage.children(spark, f"{root}/absent") == []
    storage.delete(spark, f"{root}/b")
    assert not storage.exists(spark, f"{root}/b")
