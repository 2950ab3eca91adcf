"""Islands of contiguous ids, and draws that hit an id whatever the gaps.

An id minus its number in id order is the same for all ids of a contiguous run,
so the runs are the groups of that difference; the numbers come from a scan by
ranges. With the count of ids before each run, the n-th id is found by rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.scan import scan
from starloom.operators.store import materialize

#: Most islands that are searched as one array in each task (24 bytes each).
SEARCHED = 50_000


def at_or_below(points: Column, x: Column, most: int) -> Column:
    """How many of the sorted array ``points`` (``most`` at the most) are not above ``x``: a
    binary search, as one expression."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(max(1, most.bit_length())))))
    return F.aggregate(steps, F.lit(0), lambda i, s: F.when(F.coalesce(F.get(points, i + s - 1) <= x, F.lit(False)), i + s).otherwise(i))


def key_islands(df: DataFrame, key: str, ranges: int | None = None) -> DataFrame:
    """(low_id, high_id, n_ids, ids_before) of each run of contiguous values of ``key``. NULLs
    are no ids; repeated ids count once."""
    ids = df.select(F.col(key).cast("bigint").alias("_id")).where("_id IS NOT NULL").distinct()
    numbered = scan(ids, [], ["_id"], number="_n", ranges=ranges)
    return numbered.groupBy((F.col("_id") - F.col("_n")).alias("_run")).agg(
        F.min("_id").alias("low_id"), F.max("_id").alias("high_id"), F.count(F.lit(1)).alias("n_ids"), (F.min("_n") - 1).alias("ids_before")).drop("_run")


def pick(draws: DataFrame, islands: DataFrame, rank: str, into: str, searched: int = SEARCHED, ranges: int | None = None) -> DataFrame:
    """``draws`` with the id of each ``rank`` (0 to the number of ids less one) as ``into``; NULL for
    other ranks. ``islands`` are stored. Few islands are searched in an array; beyond
    ``searched`` of them draws and islands are merged in order."""
    n = islands.count()
    if n <= searched:
        tables = islands.agg(F.sort_array(F.collect_list(F.struct("ids_before", "low_id", "n_ids"))).alias("t"))
        out = draws.withColumn("_islands", tables.scalar()).withColumn(
            "_at", F.get("_islands", at_or_below(F.transform("_islands", lambda x: x["ids_before"]), F.col(rank).cast("bigint"), n) - 1))
        out = out.drop("_islands")
    else:
        tops = islands.select(F.col("ids_before").alias("_rank"), F.lit(0).alias("_kind"), F.struct("ids_before", "low_id", "n_ids").alias("_island"))
        rows = draws.select(F.col(rank).cast("bigint").alias("_rank"), F.lit(1).alias("_kind"), F.struct(*draws.columns).alias("_draw"))
        both = scan(tops.unionByName(rows, allowMissingColumns=True), [], ["_rank", "_kind"], last={"_at": "_island"}, ranges=ranges)
        out = both.where("_kind = 1").select("_draw.*", "_at")
    off = F.col(rank) - F.col("_at.ids_before")
    return out.withColumn(into, F.when((off >= 0) & (off < F.col("_at.n_ids")), F.col("_at.low_id") + off).cast("bigint")).drop("_at")


def islands_and_count(df: DataFrame, key: str) -> tuple[DataFrame, object]:
    """Stored islands of ``key``, and the number of its ids as a scalar column."""
    found = materialize(key_islands(df, key), "islands")
    return found, found.agg(F.sum("n_ids")).scalar()
