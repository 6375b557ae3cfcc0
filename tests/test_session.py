import pytest

from natspark.session import ensure_checkpoint_dir, scratch_path


class _Conf:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if key == "spark.checkpoint.dir" else default


class _Context:
    def __init__(self, master, configured=None, current=None):
        self.master, self._conf, self._dir = master, _Conf(configured), current

    def getCheckpointDir(self):
        return self._dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, path):
        self._dir = path


class _Session:
    def __init__(self, sc):
        self.sparkContext = sc


def test_configured_dir_is_used_and_kept():
    sc = _Context("yarn", configured="hdfs://nn/ckpt")
    assert ensure_checkpoint_dir(_Session(sc)) == "hdfs://nn/ckpt"
    sc2 = _Context("yarn", configured="hdfs://nn/other", current="hdfs://nn/already")
    assert ensure_checkpoint_dir(_Session(sc2)) == "hdfs://nn/already"


def test_unset_on_cluster_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session(_Context("yarn")))


def test_unset_locally_gets_a_scratch_dir():
    path = ensure_checkpoint_dir(_Session(_Context("local[2]")))
    assert path and "natspark-ckpt-" in path


def test_scratch_paths_are_unique_and_under_the_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    base = spark.sparkContext.getCheckpointDir().rstrip("/")
    assert a != b and a.startswith(base) and b.startswith(base)
