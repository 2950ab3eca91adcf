"""MERGE, UPDATE and DELETE on a stored table, partition by partition.

A change touches the partitions that hold (or will hold) its rows. Only these are
read whole, rewritten next to the table and put in their place by dynamic
partition overwrite; the files of all others stay as they are. Which partitions a
change touches is found by a scan of the columns it needs; their number, not the
rows', passes through the driver.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.store import materialize

_OLD = "_old_partition"


def _exactly(values: list, cols: list[str]) -> Column:
    """Rows of these partitions (tuples of ``cols``); a filter that prunes folders."""
    one = lambda v: reduce(and_, [F.col(c).isNull() if x is None else F.col(c) == F.lit(x) for c, x in zip(cols, v)])
    return reduce(or_, map(one, values), F.lit(False))


def _found(rows: DataFrame, by: list[str]) -> list[tuple]:
    return [tuple(r) for r in rows.select(*by).distinct().collect()]


def _replace(spark: SparkSession, path: str, rows: DataFrame, touched: list[tuple], by: list[str]) -> int:
    """Put ``rows`` in the place of the ``touched`` partitions; one without rows goes."""
    if not touched:
        return 0
    new = materialize(rows, "partitions")  # complete before the table changes; it reads the old files
    left = set(_found(new, by))
    table = spark.read.parquet(path)
    # folders of partitions that end up empty: an overwrite would leave them as they are
    gone = table.where(_exactly([v for v in touched if v not in left], by)).select(F.regexp_replace(F.input_file_name(), "/[^/]*$", "").alias("d")).distinct().collect()
    if left:
        (new.select(*table.columns).repartition(*by).sortWithinPartitions(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*by).parquet(path))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for r in gone:
        folder = spark.sparkContext._jvm.java.net.URI(r["d"]).getPath() if "%" in r["d"] else r["d"]
        p = hadoop(folder)
        p.getFileSystem(conf).delete(p, True)
    return len(touched)


def merge_rows(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], by: list[str]) -> int:
    """``MERGE``: rows of ``changes`` (all columns of the table) replace the rows with their
    ``keys``, wherever those are, or are added. Keys must be unique in ``changes``; of NULL
    keys nothing is replaced. Returns how many of the partitions by ``by`` were rewritten."""
    table = spark.read.parquet(path)
    new = materialize(changes.select(*table.columns), "changes")
    if new.groupBy(*keys).count().where("count > 1").take(1):
        raise ValueError("a key occurs more than once in the changes")
    hit = table.select(*keys, *by).join(new.select(*keys), keys, "left_semi")
    touched = sorted({*_found(hit, by), *_found(new, by)}, key=str)
    rest = table.where(_exactly(touched, by)).join(new.select(*keys), keys, "left_anti")
    return _replace(spark, path, rest.select(*table.columns).unionByName(new), touched, by)


def update_rows(spark: SparkSession, path: str, where: Column, values: dict[str, Column], by: list[str]) -> int:
    """``UPDATE ... SET`` on the rows that meet ``where``; a row may move to another
    partition. Returns how many partitions were rewritten."""
    table = spark.read.parquet(path)
    hit = table.where(where)
    changed = lambda df: df.select(*((values[c].cast(df.schema[c].dataType).alias(c) if c in values else F.col(c)) for c in df.columns))
    touched = sorted({*_found(hit, by), *(_found(changed(hit), by) if set(values) & set(by) else ())}, key=str)
    own = table.where(_exactly(touched, by)).withColumn(_OLD, F.coalesce(where, F.lit(False)))
    rows = own.where(~F.col(_OLD)).drop(_OLD).unionByName(changed(own.where(_OLD).drop(_OLD)))
    return _replace(spark, path, rows, touched, by)


def delete_rows(spark: SparkSession, path: str, where: Column, by: list[str]) -> int:
    """``DELETE`` the rows that meet ``where`` (NULL is not met). Returns how many
    partitions were rewritten or went."""
    table = spark.read.parquet(path)
    touched = sorted(_found(table.where(where), by), key=str)
    return _replace(spark, path, table.where(_exactly(touched, by)).where(~F.coalesce(where, F.lit(False))), touched, by)
