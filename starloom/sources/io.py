"""Table writes: create-as-select, append by column name, overwrite.

Outputs are parquet directories. Spark deletes the old files of an
``overwrite`` before it writes the new ones, so ``write_table`` first writes
next to the table and swaps the folders when that has succeeded: a write that
fails leaves the old rows. The swap is two renames. On a file system they are quick,
and a reader between them finds no table; on an object store each rename copies all
files, so there write to a new path and tell readers of it instead.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    """``CREATE TABLE t AS SELECT`` / ``DELETE FROM t`` + reload."""
    swap = mode == "overwrite"
    target = f"{path.rstrip('/')}.new-{uuid.uuid4().hex}" if swap else path
    w = df.write.mode("error" if swap else mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = _file_system(spark, target)
    try:
        w.parquet(target)
    except BaseException:
        if swap:
            fs.delete(hadoop(target), True)
        raise
    if swap:
        old = f"{target}.old"
        if fs.exists(hadoop(path)) and not fs.rename(hadoop(path), hadoop(old)):
            # Hadoop says so instead of raising; the next rename would move the new folder into the old one
            raise OSError(f"the new table is complete at {target} but the old one at {path} can't be moved aside")
        if not fs.rename(hadoop(target), hadoop(path)):
            raise OSError(f"the new table is complete at {target} but can't take the place of {path}")
        fs.delete(hadoop(old), True)


def append_by_name(df: DataFrame, path: str, spark: SparkSession,
                   partition_by: list[str] | None = None) -> None:
    """``INSERT INTO t SELECT ...``: columns are matched by name against the
    existing table (missing and surplus columns are an error, not a silent
    positional shift or loss)."""
    target_cols = spark.read.parquet(path).columns
    missing = [c for c in target_cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for append: {missing}")
    if surplus := [c for c in df.columns if c not in target_cols]:
        raise ValueError(f"columns that the table does not have: {surplus}")
    write_table(df.select(*target_cols), path, partition_by, mode="append")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


HOLIDAY_SCHEMA = "holiday_date date, festive_event string"


def read_holidays(spark: SparkSession, path: str, fmt: str = "csv", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """A holiday table (date, event name) from CSV (header row) or parquet,
    read with an explicit schema; it feeds ``calendar.apply_holidays``. Text
    dates have ``date_format`` (say ``dd/MM/yyyy``); another form is an error."""
    if fmt == "csv":
        options = {"header": "true", "dateFormat": date_format, "mode": "FAILFAST"}
        return spark.read.schema(HOLIDAY_SCHEMA).options(**options).csv(path)
    return spark.read.schema(HOLIDAY_SCHEMA).parquet(path)
