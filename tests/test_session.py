import pytest

from lexmill import session


class Fake:
    """As much of a session as ``shared_folder`` looks at."""

    def __init__(self, master, given=None, held=None):
        self.conf, self.sparkContext, self.master, self._given, self._held = self, self, master, given, held

    def get(self, name, default):
        return self._given

    def getCheckpointDir(self):  # noqa: N802
        return self._held


def test_a_cluster_names_its_shared_folder():
    with pytest.raises(RuntimeError):
        session.shared_folder(Fake("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.shared_folder(Fake("local-cluster[2,1,1024]"))
    assert session.shared_folder(Fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.shared_folder(Fake("yarn", None, "hdfs:///held")) == "hdfs:///held"
    assert session.shared_folder(Fake("local[4]"))


def test_small_inputs_are_dealt_to_all_cores(spark):
    assert session.dealt(spark.range(10, numPartitions=1)).rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
    assert session.dealt(spark.range(10, numPartitions=50)).rdd.getNumPartitions() == 50
