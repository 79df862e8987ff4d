import pytest

from featloom.sources.scratch import scratch_path


class Session:
    """The settings a scratch path is made from."""

    def __init__(self, **settings):
        self.conf = self
        self.settings = settings

    def get(self, name, default):
        return self.settings.get(name.removeprefix("spark.").replace(".", "_"), default)


def test_paths_are_new_and_below_the_setting(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and first.startswith(f"{folder}/x-")
    assert scratch_path(Session(checkpoint_dir="s3a://b/c/"), "x").startswith("s3a://b/c/x-")


def test_the_warehouse_stands_in_locally():
    both = Session(checkpoint_dir="hdfs://a", sql_warehouse_dir="hdfs://b")
    assert scratch_path(both, "x").startswith("hdfs://a/")
    assert scratch_path(Session(sql_warehouse_dir="hdfs://b"), "x").startswith("hdfs://b/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
    for master in ("spark://host:7077", "yarn", "k8s://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(Session(master=master, sql_warehouse_dir="hdfs://b"), "x")
        assert scratch_path(Session(master=master, checkpoint_dir="hdfs://a"), "x").startswith("hdfs://a/")
    assert scratch_path(Session(master="local[8]", sql_warehouse_dir="hdfs://b"), "x").startswith("hdfs://b/")
