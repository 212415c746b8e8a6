import pytest

from pulsekit.session import CLUSTER_CONF, ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master, self._conf, self.dir = master, _Conf(conf), None

    def getCheckpointDir(self):  # noqa: N802 - mirrors SparkContext
        return self.dir

    def getConf(self):  # noqa: N802
        return self._conf

    def setCheckpointDir(self, path):  # noqa: N802
        self.dir = path


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf(conf or {})


def test_cluster_without_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://cluster:7077"))
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("yarn"), fallback="/tmp/only-here")


def test_configured_folder_wins_and_local_falls_back(tmp_path):
    shared = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(shared) == "hdfs:///shared/ckpt"
    local = _Session("local[4]")
    assert ensure_checkpoint_dir(local, fallback=str(tmp_path / "ck")).endswith("ck")


def test_cluster_profile_sizes_shuffles_and_cleans_checkpoints():
    assert int(CLUSTER_CONF["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 1000
    assert CLUSTER_CONF["spark.cleaner.referenceTracking.cleanCheckpoints"] == "true"
