"""Where scratch goes."""

import pytest

from roadpulse.sources.shared_dir import scratch_base, scratch_path


def test_the_checkpoint_folder_comes_first():
    assert scratch_base("spark://host:7077", "hdfs://a/b", "file:/w") == "hdfs://a/b"
    assert scratch_base("spark://host:7077", "file:/shared", "file:/w") == "file:/shared"


def test_a_local_session_may_use_its_own_disk():
    assert scratch_base("local[8]", None, "file:/w") == "file:/w"


@pytest.mark.parametrize("warehouse", ["file:/w", "/w"])
@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host"])
def test_a_machines_own_disk_is_refused_on_a_cluster(master, warehouse):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_base(master, None, warehouse)


def test_a_shared_warehouse_serves_a_cluster():
    assert scratch_base("yarn", None, "hdfs://a/w") == "hdfs://a/w"


def test_paths_are_new_each_time(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
