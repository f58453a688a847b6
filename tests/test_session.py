from types import SimpleNamespace

import pytest

from suturestar.session import scratch, shared_folder


def _session(**conf):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf.get(key.split(".")[1], default)))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch(spark, "x").startswith(shared_folder(spark)) and scratch(spark, "x") != scratch(spark, "x")


def test_a_local_folder_only_for_local_threads():
    unset = _session(master="local[4]")
    assert shared_folder(unset) == shared_folder(unset) != ""


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]", "spark://host:7077", ""])
def test_a_cluster_must_name_its_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(_session(master=master))
