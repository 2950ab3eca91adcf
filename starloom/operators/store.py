"""Copies under the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from starloom.session import ensure_checkpoint_dir

_STORED: list[str] = []


def scratch_path(spark, tag: str) -> str:
    """A new folder name under the shared checkpoint folder; ``release_stored`` deletes it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/starloom-{tag}-{uuid.uuid4().hex}"
    _STORED.append(path)
    return path


def materialize(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: a lineage cut that survives executor loss."""
    path = scratch_path(df.sparkSession, tag)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def release_stored(spark) -> int:
    """Delete the copies that ``materialize`` has written
    so far in this process. Call it when the results that read them are stored;
    frames that still read them fail afterwards. Returns how many there were."""
    jvm, n = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _STORED:
        p = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        n += bool(p.getFileSystem(conf).delete(p, True))
    return n
