"""Order-keyed facts in equal buckets, so joins on the order need no shuffle.

Nearly every library, enrollment and sales plan joins lines with orders. The
build writes both bucketed and sorted by the order key with one number of
buckets; ``BucketedWarehouse`` reads them, and all plans run on it unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.sources.tables import Warehouse

#: The raw tables that are keyed by order, and their key; lines for each bucket.
ORDER_KEYED = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
BUCKET_ROWS = 4_000_000


class BucketedWarehouse(Warehouse):
    """A warehouse whose order-keyed tables are catalog tables ``prefix``_name."""

    def __init__(self, spark: SparkSession, sf_dir: str, prefix: str, days=None):
        super().__init__(spark, sf_dir, days)
        self.prefix = prefix

    def raw(self, name: str) -> DataFrame:
        if name not in ORDER_KEYED:
            return super().raw(name)
        return self.memo(f"raw:{name}", lambda: self.spark.table(f"{self.prefix}_{name}"))


def write_order_buckets(wh: Warehouse, prefix: str, out_dir: str, buckets: int | None = None) -> BucketedWarehouse:
    """Write the order-keyed tables of ``wh`` under ``out_dir`` as tables ``prefix``_name. The
    number of buckets follows the lines (and is the shuffle partitions at least), and
    is the same for all; a task writes one sorted file of one bucket."""
    spark = wh.spark
    if buckets is None:
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-wh.raw("lineitem").count() // BUCKET_ROWS))
    for name, key in ORDER_KEYED.items():
        (wh.raw(name).repartition(buckets, key).write.format("parquet").mode("overwrite").option("path", f"{out_dir.rstrip('/')}/{name}")
         .bucketBy(buckets, key).sortBy(key).saveAsTable(f"{prefix}_{name}"))
    return BucketedWarehouse(spark, wh.sf_dir, prefix)
