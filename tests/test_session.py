import pytest

from usageledger import session


@pytest.fixture
def unchanged(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.parallelismFirst"]
    before = {key: spark.conf.get(key) for key in keys}
    yield spark
    for key, value in before.items():
        spark.conf.set(key, value)


def test_shuffle_width_follows_the_input(unchanged):
    terabyte = 1024**4
    assert session.size_shuffles(unchanged, 1) == 200
    assert session.size_shuffles(unchanged, terabyte) == 2048
    assert session.size_shuffles(unchanged, 100 * terabyte) == 100_000
    assert unchanged.conf.get("spark.sql.shuffle.partitions") == "100000"


class Stub:
    """A session with the given settings and nothing else."""

    def __init__(self, master, settings):
        self.conf, self.sparkContext, self.master, self.folder = self, self, master, None
        self.get = settings.get

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_scratch_lives_in_the_folder_the_cluster_names():
    named = Stub("spark://head:7077", {"spark.checkpoint.dir": "hdfs://shared/ckpt/"})
    one, two = session.scratch_path(named, "x"), session.scratch_path(named, "x")
    assert one.startswith("hdfs://shared/ckpt/x-") and one != two


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(Stub("yarn", {}), "x")


def test_a_local_session_gets_a_folder_once():
    local = Stub("local[2]", {})
    first = session.shared_folder(local)
    assert first == session.shared_folder(local)
