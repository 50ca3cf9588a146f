from types import SimpleNamespace

import pytest

from ticketmart import config


class Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, named=None):
    values = {"spark.checkpoint.dir": named, "spark.sql.warehouse.dir": "file:/warehouse"}
    conf = SimpleNamespace(get=lambda key, default=None: values.get(key) or default)
    return SimpleNamespace(conf=conf, sparkContext=Context(master))


def test_the_folder_the_cluster_names_is_taken():
    assert config.shared_folder(session("yarn", "hdfs:///shared/")) == "hdfs:///shared"


def test_a_local_session_takes_a_folder_of_the_warehouse():
    assert config.shared_folder(session("local[8]")) == "file:/warehouse/_shared"


@pytest.mark.parametrize("master", ["yarn", "local-cluster[3,2,3000]"])
def test_a_cluster_without_a_named_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        config.shared_folder(session(master))


def test_scratch_paths_are_new(spark):
    first, second = config.scratch(spark, "x"), config.scratch(spark, "x")
    assert first != second
    assert first.startswith(config.shared_folder(spark))
