"""Shards of near equal bytes by sampled splitters; DataFrame functions only.

Records are ordered by (digest of the text, doc_id). Key samples are drawn with a
probability by size, their quantiles bound the ranges, and records are dealt by
range. A range that holds more than twice its share is subdivided by further samples
of its own. Each range is then numbered by itself and moved by the sums of the ranges
before it, which gives every record's exact place in the whole order without a
sort of everything in one task. The shards are cut from that order at equal bytes.

Equal texts are neighbours in the order. A cut that falls into a group of equal texts
moves to the group's nearer end if the group holds at most 1 / ``WHOLE`` of a shard's
bytes, so such groups are never divided; a larger group is divided between records.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import stored

SHARDS, WHOLE = 40, 64
#: Samples drawn for each range, and bytes that a record counts besides its text.
SAMPLES, OVERHEAD = 64, 16
_ROW = "__row"
_POINT = ["key", "id", _ROW]


def _search(splits: Column, point: Column, most: int) -> Column:
    """How many of the sorted ``splits`` (``most`` at the most) are not above the point; binary search."""
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(max(1, most.bit_length())))))
    return F.aggregate(steps, F.lit(0), lambda i, s: F.when(F.coalesce(F.get(splits, i + s - 1) <= point, F.lit(False)), i + s).otherwise(i))


def _ranged(rows: DataFrame, splits: DataFrame | None, n: int) -> DataFrame:
    """``rows`` with the number of their range between the splitters."""
    if not n:
        return rows.withColumn("range", F.lit(0))
    table = splits.agg(F.sort_array(F.collect_list("point")).alias("points"))
    return rows.withColumn("points", table.scalar()).withColumn("range", _search(F.col("points"), F.struct(*_POINT), n)).drop("points")


def _ranges(rows: DataFrame, ranges: int, samples: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` (with their weight, all weights sum to 1) with a range each, and the
    ranges' sums. No range weighs more than two shares besides its heaviest row."""
    splits, n, rate, over = None, 0, ranges * samples, rows.withColumn("range", F.lit(0))
    while True:
        luck = F.pmod(F.xxhash64(*_POINT, F.lit(rate)), F.lit(1 << 52)) / F.lit(float(1 << 52))
        drawn = over.where(luck < rate * F.col("weight")).select("range", F.struct(*_POINT).alias("point"), F.greatest("weight", F.lit(1.0) / rate).alias("w"))
        upto = F.sum("w").over(Window.partitionBy("range").orderBy("point"))
        new = drawn.withColumn("upto", upto).where(F.floor(F.col("upto") * ranges) > F.floor((F.col("upto") - F.col("w")) * ranges)).select("point")
        splits = stored(new if splits is None else new.unionByName(splits).distinct(), "splits")
        n = splits.count()
        placed = _ranged(rows, splits, n)
        sums = stored(placed.groupBy("range").agg(F.sum("weight").alias("weight"), F.max("weight").alias("heaviest"), F.sum("size").alias("bytes"),
                                                  F.count(F.lit(1)).alias("rows")), "ranges")
        full = sums.where(F.col("weight") - F.col("heaviest") > 2.0 / ranges).select("range")
        if not full.take(1):
            return placed, sums
        over, rate = placed.join(F.broadcast(full), "range", "left_semi"), rate * 2  # one row for each range


def _placed(rows: DataFrame, shards: int, whole: int, ranges: int, samples: int) -> DataFrame:
    """``rows`` (key, id, row tag, size) with shard and slot."""
    total, count = rows.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not count:
        return rows.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    ranged, sums = _ranges(rows.withColumn("weight", F.col("size") / (2 * total) + F.lit(0.5 / count)), ranges, samples)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    base = sums.select("range", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes0"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows0"))
    own = Window.partitionBy("range").orderBy(*_POINT)
    placed = ranged.drop("weight").withColumn("upto", F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("at", F.row_number().over(own) - 1).join(F.broadcast(base), "range")
    placed = stored(placed.select(*rows.columns, (F.col("bytes0") + F.col("upto") - F.col("size")).alias("start"),
                                  (F.col("bytes0") + F.col("upto")).alias("end"), (F.col("rows0") + F.col("at")).alias("at")), "placed")
    # the record that covers each of the equal cuts, and the group it belongs to: a row for each cut
    nth = lambda c: F.expr(f"({c} * {shards} + {total - 1}) div {total}")
    cover = placed.select("key", "start", "end", F.greatest(nth("start"), F.lit(1)).alias("i"), F.least(nth("end") - 1, F.lit(shards - 1)).alias("j")) \
        .where("i <= j").select("key", "start", "end", F.explode(F.sequence("i", "j")).alias("i"))
    cover = stored(cover, "cover")
    group = placed.join(F.broadcast(cover.select("key").distinct()), "key", "left_semi").groupBy("key").agg(F.min("start").alias("g0"), F.max("end").alias("g1"))
    ends = cover.join(group, "key").withColumn("keep", (F.col("g1") - F.col("g0")) * (whole * shards) <= total)
    lo, hi = (F.when(F.col("keep"), F.col(g)).otherwise(F.col(r)) for g, r in (("g0", "start"), ("g1", "end")))
    cut = F.expr(f"i * {total} div {shards}")
    cuts = sorted(r[0] for r in ends.select(F.when(cut - lo <= hi - cut, lo).otherwise(hi)).collect())  # shards - 1 numbers
    points = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    placed = placed.withColumn("shard", _search(points, F.col("start"), len(cuts)) if cuts else F.lit(0))
    first = placed.groupBy("shard").agg(F.min("at").alias("first"))
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("at") - F.col("first"))


def _narrow(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"), _ROW,
                       F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long").alias("key"),
                       (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))


def _ranges_of(docs: DataFrame) -> int:
    """Four ranges for each shuffle partition of the session, so its tasks come out even."""
    return 4 * max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def assign(docs: DataFrame, shards: int = SHARDS, whole: int = WHOLE, ranges: int | None = None, samples: int = SAMPLES) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> doc_id, size, text_crc32,
    law, shard, slot, grown_shard, a row per row.

    The law is ``bytes``: sizes (UTF-8 bytes of the text plus 16) of the shards differ
    from the mean by half a record or 1 / ``whole`` of a shard at most at each end. slot
    counts a shard's rows from 0. A null text is empty; a null doc_id comes first within its
    text; rows that repeat are rows of their own, in any order among them. With
    fewer rows than shards some shards are empty. Empty table: empty result.
    """
    rows = stored(_narrow(docs.select("doc_id", "text", F.monotonically_increasing_id().alias(_ROW))), "records")
    placed = _placed(rows, shards, whole, ranges or _ranges_of(docs), samples)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, whole: int = WHOLE, files: int = 1) -> None:
    """Write whole ``docs`` as Parquet in a folder for each shard (``shard=N``), rows in
    the order of their slot, about ``files`` files a shard. Columns of docs that are
    named shard or slot are replaced."""
    rows = stored(docs.drop("shard", "slot").withColumn(_ROW, F.monotonically_increasing_id()), "documents")
    placed = stored(_placed(_narrow(rows), shards, whole, _ranges_of(docs), SAMPLES).select(_ROW, "shard", "slot"), "placed")
    out = rows.join(placed.hint("merge"), _ROW).drop(_ROW)
    out.repartitionByRange(math.ceil(shards * files), "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
