"""Dense surrogate keys (the role of an Oracle sequence in a bulk load).

``row_number().over(Window.orderBy(...))`` without a partition moves every
row into one task. Here the rows are numbered by a scan over their global
order (see ``scan``): written once, cut into ranges, numbered range by range,
each range moved by the count of the rows before it. The stored copy fixes the
numbering, so a lost executor or another read order cannot renumber rows.

The order columns must form a total order (append a unique column when
they do not), otherwise ties are numbered in an unspecified order.

``KeyMap`` is the sequence across loads: a stored table of natural and surrogate
keys that later loads extend.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.scan import scan
from starloom.operators.store import materialize, release_stored

__all__ = ["KeyMap", "materialize", "release_stored", "surrogate_key"]


def surrogate_key(df: DataFrame, order_cols: list, key_col: str = "sk", start: int = 1,
                  num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = start, start+1, ... following ``order_cols``."""
    numbered = scan(df, [], list(order_cols), number=key_col, ranges=num_partitions)
    return numbered.withColumn(key_col, F.col(key_col) + (start - 1))


class KeyMap:
    """Stored map from a natural key to a dense surrogate key that loads extend.

    ``name`` is a table of the session's catalog, bucketed and sorted by the natural
    key; ``buckets`` is set when it is first written (about one for ``BUCKET_ROWS`` keys of
    the first load, unless given) and stored with it. A load anti-joins its keys with
    the map (the map's side is read bucket by bucket, without a shuffle), numbers the new
    ones densely above the highest number in use, in the order of the natural key, and
    appends them. Keys that are there never change. ``path`` puts the table's files
    into a folder of the caller's choice.
    """

    BUCKET_ROWS = 1_000_000

    def __init__(self, spark, name: str, keys: list[str], key_col: str = "sk", start: int = 1,
                 buckets: int | None = None, path: str | None = None):
        self.spark, self.name, self.keys, self.key_col = spark, name, keys, key_col
        self.start, self.buckets, self.path = start, buckets, path

    def read(self) -> DataFrame | None:
        """The map as it is, or None before the first load."""
        return self.spark.table(self.name) if self.spark.catalog.tableExists(self.name) else None

    def _buckets(self, rows: int) -> int:
        if not self.spark.catalog.tableExists(self.name):
            return self.buckets or max(1, -(-rows // self.BUCKET_ROWS))
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Num Buckets'").first()
        return int(told["data_type"])

    def load(self, rows: DataFrame) -> int:
        """Give every natural key of ``rows`` that has none a number; returns how many
        were new. Repeated keys count once; rows with a NULL in the key get none."""
        known = self.read()
        wanted = rows.select(*self.keys).where(" AND ".join(f"{c} IS NOT NULL" for c in self.keys)).distinct()
        top = self.start - 1
        if known is not None:
            wanted = wanted.join(known.hint("merge"), self.keys, "left_anti")
            top = known.agg(F.coalesce(F.max(self.key_col), F.lit(top))).first()[0]
        fresh = materialize(surrogate_key(wanted, self.keys, self.key_col, top + 1), "new-keys")
        n = fresh.count()
        if n or known is None:
            size = self._buckets(n)
            writer = fresh.repartition(size, *self.keys).write.format("parquet").mode("append").bucketBy(size, *self.keys).sortBy(*self.keys)
            (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)
        return n

    def attach(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their surrogate key (NULL where the map has none)."""
        return rows.join(self.read(), self.keys, "left")
