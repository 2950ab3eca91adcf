"""A third of all rows on one (order, product): results stay exact and the
work is not funnelled into one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators.dedup import duplicate_rec_nos, duplicate_summary, first_per_pair
from starloom.operators.keys import surrogate_key

ORDER = ["orderid", "productid", "suppkey", "linenumber"]


def _skewed(spark, n=30000):
    base = spark.range(n).select(
        (F.col("id") % 3000).alias("orderid"), (F.col("id") % 7).alias("productid"),
        (F.col("id") % 11).alias("suppkey"), F.col("id").cast("int").alias("linenumber"))
    hot = spark.range(n // 2).select(F.lit(1).cast("bigint").alias("orderid"),
                                     F.lit(1).cast("bigint").alias("productid"),
                                     (F.col("id") % 5).alias("suppkey"),
                                     (F.col("id") + n).cast("int").alias("linenumber"))
    return base.unionByName(hot)


def test_hot_pair_dedup_and_keys(spark):
    lines = _skewed(spark)
    total = lines.count()
    first = first_per_pair(lines, ORDER, ORDER)
    brute = (lines.withColumn("rn", F.row_number().over(
        Window.partitionBy("orderid", "productid").orderBy("suppkey", "linenumber")))
        .filter("rn = 1").drop("rn"))
    assert sorted(first.collect()) == sorted(brute.collect())

    keyed = surrogate_key(lines, ORDER, "rec_no", 1, num_partitions=8)
    sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == total and max(sizes) < total / 3      # the hot pair is split up

    dups = {r.rec_no for r in duplicate_rec_nos(keyed).collect()}
    ranked = keyed.withColumn("rn", F.row_number().over(
        Window.partitionBy("orderid", "productid").orderBy("rec_no")))
    expected = {r.rec_no for r in ranked.filter("rn > 1").select("rec_no").collect()}
    assert dups == expected

    s = duplicate_summary(lines).first()
    assert s.total_rows == total and s.duplicate_rows == total - first.count()


def test_lines_are_numbered_once(spark):
    """Deleting reads the numbered lines twice; their numbering (a window) is not in its plan."""
    from starloom.registry import QUERIES

    out = QUERIES["delete_duplicates"](spark, "/root/testdata/sf0.001")
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
