"""Checkpoint-directory rules, on stub sessions (no cluster needed)."""

import pytest

from starloom.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _SC:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _Conf(conf)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, d):
        self.dir = d

    def getConf(self):
        return self._conf


class _Spark:
    def __init__(self, master, conf=()):
        self.sparkContext = _SC(master, dict(conf))
        self.conf = _Conf(dict(conf))


def test_cluster_without_shared_folder_fails():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Spark("yarn"))


def test_cluster_uses_the_configured_folder():
    s = _Spark("spark://master:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_session_gets_a_private_folder():
    s = _Spark("local[2]")
    d = ensure_checkpoint_dir(s)
    assert d and d == s.conf.get("spark.checkpoint.dir")


def test_materialize_writes_under_the_checkpoint_folder(spark):
    from starloom.operators.keys import materialize
    df = materialize(spark.range(10), "probe")
    base = spark.sparkContext.getCheckpointDir().rstrip("/")
    files = df.inputFiles()
    assert files and all(f.startswith(base) or f.replace("file://", "file:").startswith(base)
                         for f in files)
    assert df.count() == 10


@pytest.mark.parametrize("master,ok", [("local", True), ("local[*]", True), ("local-cluster[2,1,1024]", False)])
def test_only_a_single_process_gets_a_private_folder(master, ok):
    """The executors of local-cluster are processes of their own."""
    if ok:
        assert ensure_checkpoint_dir(_Spark(master))
    else:
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(_Spark(master))
