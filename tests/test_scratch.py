import pytest

from shopgrain.sources import scratch


class Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


class Session:
    def __init__(self, **conf):
        self.conf = Conf({k.replace("_", "."): v for k, v in conf.items()})


def test_the_named_folder_is_used():
    session = Session(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")
    assert scratch.scratch_root(session) == "hdfs://x/y"


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session(spark_master="yarn"))


def test_a_local_run_gets_a_folder_once():
    session = Session(spark_master="local[2]")
    assert scratch.scratch_root(session) == scratch.scratch_root(session)


def test_written_tables_read_back(spark):
    df = scratch.materialise(spark.range(5), "t")
    assert df.count() == 5 and df.inputFiles()
