"""Connected components of an edge table by alternating large-star and
small-star steps (public algorithm of Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) -> (id, component): the smallest id that each
    id of an edge can reach. Ids without an edge do not appear; self-loops and
    repeated edges do no harm. Each step is stored, so a lost executor costs a
    step; the joins keep AQE's skew split for a vertex with many edges.
    """
    e = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
               .distinct(), "edges")
    seen = None
    while True:
        size, mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if (size, mark) == seen or not size:
            break
        seen = (size, mark)
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("m", "a").alias("m"))
        large = (both.join(low, F.col("a") == F.col("u")).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        large = stored(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        small = large.join(low, F.col("a") == F.col("u"))
        e = stored(small.select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                                  F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
                   .select("x.a", "x.b").where("a != b").distinct(), "edges")
    roots = e.select(F.col("b").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
