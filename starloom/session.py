"""Spark session defaults and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of the library wants; sized for local runs and
# overridable through spark-submit on a cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.ansi.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given (tests and bench pass ``local[N]``);
    on a cluster spark-submit decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it up if needed.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that one
    is always used. Only a local-mode session without the setting (tests,
    bench) gets a fresh private folder under the temp directory; a cluster
    session without it is an error, never a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):  # not local-cluster: its executors are processes of their own
        path = tempfile.mkdtemp(prefix="starloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", path)
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set: point it at a shared folder (HDFS/S3/ABFS) "
        "that every executor can reach")
