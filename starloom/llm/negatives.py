"""Hard negatives by anchor-clustered shared lists (after MAXIMUS).

Anchors are clustered by direction. A candidate x at an angle t from a cluster's
centre scores at most |a| |x| cos(max(0, t - w)) against each member a, w being the
widest angle of a member. Candidates lie in tiles (rows of one direction cell, at most
``TILE_BYTES``); each cluster sorts the tiles once by the largest such bound of their
rows, and all its members walk that list. A member stops as soon as the bound of the
next tile is below the worst score that it still needs: all its results are then
certain. The walk goes in waves of growing length; a wave brings the members that go on
to their tiles, so vectors of candidates are not copied for each cluster.

The first walk finds an anchor's positives, the second its negatives for each of
them. Scores are integers: products in double precision where the vectors' lengths
prove all sums below 2**53, else Python's integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, stored

POSITIVES, NEGATIVES, LOW, HIGH, SCALE = 5, 10, 30, 90, 256
#: Bytes of a tile's vectors in a task, and its fewest rows (a parameter of speed).
TILE_BYTES, TILE_ROWS = 1 << 25, 1024
#: Bounds of what is fitted: rows sampled, centres of the candidates' cells and of the anchors' clusters.
FIT_ROWS, CELLS, CLUSTERS = 16_384, 1024, 64
FIRST, GROWTH = 4, 8
_FAR = (1 << 63) - 1


def _unpacked(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _packed(dim: int, kind: str, scale: int):
    """vec_id, label, e -> vec_id, label, q (floor of scale * e, padded with zeros), norm."""
    def run(batches):
        for b in batches:
            x = np.zeros((b.num_rows, dim))
            off = b.column(2).offsets.to_numpy()
            size = np.diff(off)
            row = np.repeat(np.arange(b.num_rows), size)
            x[row, np.arange(off[-1] - off[0]) - np.repeat(off[:-1] - off[0], size)] = b.column(2).flatten().to_numpy(zero_copy_only=False)
            q = np.floor(x * scale)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes() for r in q.astype(kind)], pa.binary()),
                                              pa.array(np.sqrt((q * q).sum(1)))], names=["vec_id", "label", "q", "norm"])
    return run


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    n = np.sqrt((x * x).sum(1))[:, None]
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


def _centres(rows: DataFrame, most: int, dim: int, kind: str, steps: int = 4) -> np.ndarray:
    """Spherical k-means on the driver over at most FIT_ROWS rows, those with the smallest hash."""
    few = rows.select("q", F.xxhash64("q").alias("h")).orderBy("h").limit(min(FIT_ROWS, 16 * most)).collect()
    x = _unit(np.frombuffer(b"".join(bytes(r[0]) for r in few), kind).reshape(-1, dim))
    c = x[np.unique(np.linspace(0, len(x) - 1, most).astype(int))]
    for _ in range(steps):
        near = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where((np.abs(sums).sum(1) > 0)[:, None], _unit(sums), c)
    return c


def _angles(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_unit(x) @ centres.T, -1, 1))


def _nearest(centres: np.ndarray, dim: int, kind: str):
    """..., q as the last column -> the same with the nearest centre and the angle to it."""
    def run(batches):
        for b in batches:
            if b.num_rows:
                t = _angles(_unpacked(b.column(b.num_columns - 1), dim, kind), centres)
                c = t.argmin(1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(c.astype(np.int32)), pa.array(t[np.arange(len(c)), c])],
                                                 names=[*b.schema.names, "centre", "angle"])
    return run


def _bounds(centres: np.ndarray, widest: np.ndarray, dim: int, kind: str):
    """tile, norm, q -> tile, cluster, bound: the largest of a batch's rows."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            tile, norm = b.column(0).to_numpy(), b.column(1).to_numpy()
            bound = norm[:, None] * (np.cos(np.clip(_angles(_unpacked(b.column(2), dim, kind), centres) - widest, 0, np.pi)) + 1e-6)
            order = np.argsort(tile, kind="stable")
            first = np.flatnonzero(np.diff(tile[order], prepend=-1))
            top = np.maximum.reduceat(bound[order], first)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(tile[order][first], len(centres))),
                                              pa.array(np.tile(np.arange(len(centres), dtype=np.int32), len(first))), pa.array(top.ravel())],
                                             names=["tile", "cluster", "bound"])
    return run


def _best(s: np.ndarray, ids: list, me: int | None, lo: list[int], hi: list[int], k: int):
    """For each window of scores: its first ``k`` rows as (window, score, id). ``s``
    are the scores of classes in descending order, ``ids`` their rows, without ``me``."""
    down = -s
    for p, (a, z) in enumerate(zip(lo, hi)):
        i, j = np.searchsorted(down, -z, "left"), np.searchsorted(down, -a, "right")
        if i >= j:
            continue
        last = min(j, i + k + (me is not None))  # a class has a row at least, if it isn't just the anchor
        j = min(j, int(np.searchsorted(down, down[last - 1], "right")))  # ties go by id
        found = sorted((-int(s[x]), y) for x in range(i, j) for y in ids[x] if y != me)
        yield from ((p, -score, y) for score, y in found[:k])


def _walk(k: int, same: bool, dim: int, kind: str, exact: bool):
    """Rows of a tile (kind 0: label, ids, q), then the anchors that come to it (kind
    1: a, label, ids, q, lo, hi), sorted so -> a, p, score, id."""
    real = float if exact else object

    def met(ask: pa.RecordBatch, x: np.ndarray, label: np.ndarray, ids: list):
        names = ask.schema.names
        of = {n: ask.column(i) for i, n in enumerate(names)}
        who, mine, me = of["a"].to_numpy(), of["label"].to_numpy(), of["ids"].to_pylist()
        lo, hi = of["lo"].to_pylist(), of["hi"].to_pylist()
        q, out = _unpacked(of["q"], dim, kind).astype(real), []
        for r in range(0, len(q), 64):
            scores = q[r:r + 64] @ x.T
            for i, s in enumerate(scores, r):
                s = s.astype(np.int64)
                few = [(a, z) for a, z in zip(lo[i], hi[i]) if a <= z]
                if not few:
                    continue
                fit = np.flatnonzero(((label == mine[i]) == same) & (s >= min(a for a, _ in few)) & (s <= max(z for _, z in few)))
                fit = fit[np.argsort(-s[fit], kind="stable")]
                out += [(who[i], *f) for f in _best(s[fit], _At(ids, fit), me[i][0] if same else None, lo[i], hi[i], k)]
        if out:
            a, p, score, found = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(p, pa.int32()), pa.array(score, pa.int64()), pa.array(found, pa.int64())],
                                             names=["a", "p", "score", "id"])

    def run(batches):
        tile, held, x, label, ids = None, [], None, None, []
        for b in batches:
            if not b.num_rows:
                continue
            key = np.column_stack([b.column(0).to_numpy(), b.column(1).to_numpy()])
            cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), b.num_rows]
            for i, j in zip(cut, cut[1:]):
                part = b.slice(i, j - i)
                if key[i, 0] != tile:
                    tile, held, x = key[i, 0], [], None
                if key[i, 1] == 0:
                    held.append(part)
                    continue
                if x is None and held:
                    t = pa.Table.from_batches(held).combine_chunks()
                    x = _unpacked(t.column("q"), dim, kind).astype(real)
                    label, ids = t.column("label").to_numpy(), t.column("ids").to_pylist()
                if x is not None:
                    yield from met(part, x, label, ids)
    return run


class _At:
    """The members of a list at the places of an index."""

    def __init__(self, values: list, at: np.ndarray):
        self.values, self.at = values, at

    def __getitem__(self, i: int):
        return self.values[self.at[i]]


def _walked(live: DataFrame, tiles: DataFrame, lists: DataFrame, k: int, same: bool, how: tuple) -> DataFrame:
    """The first ``k`` rows of each anchor's windows: a, p, score, id, place. ``live``: a,
    vec_id, label, q, norm, cluster, lo, hi; a window needs scores from lo to hi."""
    need = F.array_min(F.transform(F.filter(F.arrays_zip("lo", "hi"), lambda w: w["lo"] <= w["hi"]), lambda w: w["lo"]))
    best, begin, width = None, 0, FIRST
    while True:
        asks = live.join(lists.where(f"pos >= {begin} and pos < {begin + width}"), "cluster").where(F.col("norm") * F.col("bound") >= need) \
            .select("tile", F.lit(1).alias("kind"), "a", "label", F.array("vec_id").alias("ids"), "q", "lo", "hi")
        asks = stored(asks, "asks")
        none = F.lit(None).cast("array<bigint>")
        rows = tiles.join(asks.select("tile").distinct(), "tile", "left_semi") \
            .select("tile", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("a"), "label", "ids", "q", none.alias("lo"), none.alias("hi"))
        found = rows.unionByName(asks).repartition("tile").sortWithinPartitions("tile", "kind") \
            .mapInArrow(_walk(k, same, *how), "a long, p int, score long, id long")
        place = F.row_number().over(Window.partitionBy("a", "p").orderBy(F.desc("score"), "id"))
        best = stored((found if best is None else best.drop("place").unionByName(found)).withColumn("place", place).where(F.col("place") <= k), "best")
        begin, width = begin + width, width * GROWTH
        full = best.where(F.col("place") == k).groupBy("a").agg(F.map_from_entries(F.collect_list(F.struct("p", "score"))).alias("kth"))
        live = live.join(full, "a", "left").withColumn("lo", F.transform(
            "lo", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("kth", i), x)))).drop("kth")
        # certified: the bound of the next tile is below what is still needed
        ahead = lists.where(f"pos = {begin}").select("cluster", F.col("bound").alias("next"))
        live = stored(live.join(ahead, "cluster").where(F.col("norm") * F.col("next") >= need).drop("next"), "live")
        if not live.take(1):
            return best


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, scale: int = SCALE) -> DataFrame:
    """``vectors`` (vec_id, embedding, label; other columns are ignored) -> anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); a score is the integer inner product, equal
    ones go by the smaller vec_id. ``anchor`` says which rows are anchors. Positives are
    an anchor's first other rows of its label; for each of them, the first rows of other
    labels with low * positive <= 100 * negative <= high * positive, ranked from 1.
    Rows with a null vec_id, label or vector, or a null or non-finite component take no
    part. Shorter vectors count as padded with zeros. Rows that repeat
    wholly are one row; rows that share a vec_id but not the rest are rows of their own.
    Components of 2**62 and more after scaling, and scores beyond 64 bits, raise. Empty
    table, or no anchors: empty result.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    v = vectors.withColumn("anchor", F.coalesce(anchor, F.lit(False))) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                F.col("embedding").cast("array<double>").alias("e"), "anchor")
    v = v.where("vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL") \
        .where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    top, dim, length = v.agg(F.max(F.aggregate("e", F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))), F.max(F.size("e")),
                             F.max(F.aggregate("e", F.lit(0.0), lambda s, x: s + F.pow(F.abs(F.floor(x * scale).cast("double")), F.lit(2))))).first()
    if top is None:
        return spark.createDataFrame([], shape)
    dim, most = max(1, dim), top * scale + 1
    if most >= 2.0**62:
        raise ValueError("a component is too large to be scaled to an integer")
    kind = next(t for t, bits in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if most < 2.0**bits)
    how = (dim, kind, length < 2.0**52)
    packed = "vec_id long, label long, q binary, norm double"
    rows = v.where("anchor").select("vec_id", "label", "e").mapInArrow(_packed(dim, kind, scale), packed)
    anchors = stored(rows.distinct().withColumn("a", F.monotonically_increasing_id()), "anchors")
    count = anchors.count()
    if not count:
        return spark.createDataFrame([], shape)
    # equal vectors of a label are one class with the ids that can be among the first
    classes = v.select("vec_id", "label", "e").mapInArrow(_packed(dim, kind, scale), packed).distinct()
    nth = F.row_number().over(Window.partitionBy("q", "label").orderBy("vec_id"))
    classes = classes.withColumn("nth", nth).where(F.col("nth") <= max(positives + 1, negatives)).groupBy("q", "label") \
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"), F.first("norm").alias("norm"))
    classes = stored(classes, "classes")
    # tiles: cells of direction, cut into parts of bounded size
    size = min(max(TILE_ROWS, count), max(64, TILE_BYTES // (8 * dim)))
    cells = _centres(classes, min(CELLS, -(-classes.count() // size)), dim, kind)
    celled = stored(classes.select("label", "ids", "norm", "q").mapInArrow(
        _nearest(cells, dim, kind), "label long, ids array<bigint>, norm double, q binary, centre int, angle double").drop("angle"), "cells")
    parts = np.ones(len(cells), int)
    for c, n in celled.groupBy("centre").count().collect():  # CELLS rows at most
        parts[c] = -(-n // size)
    of = lambda n: F.array(*map(F.lit, n.tolist()))[F.col("centre")]
    tile = of(np.cumsum(parts) - parts) + F.pmod(F.xxhash64("q", "label"), of(parts))
    tiles = stored(celled.select(tile.alias("tile"), "label", "ids", "norm", "q"), "tiles")
    # clusters of anchors and the list that each of them shares
    centres = _centres(anchors, min(CLUSTERS, int(np.ceil(np.sqrt(count)))), dim, kind)
    anchors = stored(anchors.select("a", "vec_id", "label", "norm", "q").mapInArrow(
        _nearest(centres, dim, kind), "a long, vec_id long, label long, norm double, q binary, cluster int, angle double"), "anchors")
    widest = np.zeros(len(centres))
    for c, w in anchors.groupBy("cluster").agg(F.max("angle")).collect():
        widest[c] = w
    lists = tiles.select("tile", "norm", "q").mapInArrow(_bounds(centres, widest, dim, kind), "tile long, cluster int, bound double") \
        .groupBy("tile", "cluster").agg(F.max("bound").alias("bound"))
    place = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("bound"), "tile")) - 1
    lists = stored(lists.withColumn("pos", place), "lists")
    live = anchors.drop("angle").withColumn("lo", F.array(F.lit(-_FAR))).withColumn("hi", F.array(F.lit(_FAR)))
    good = _walked(live, tiles, lists, positives, True, how).drop("p")
    ranges = good.groupBy("a").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("good"))
    whole = lambda sign, share: lambda w: (sign * F.floor(sign * w["score"].cast("decimal(20,0)") * share / 100)).cast("long")
    live = anchors.drop("angle").join(ranges, "a").withColumn("lo", F.transform("good", whole(-1, low))).withColumn("hi", F.transform("good", whole(1, high)))
    bad = _walked(live.drop("good"), tiles, lists, negatives, False, how)
    named = good.select("a", (F.col("place") - 1).alias("p"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return bad.join(named, ["a", "p"]).join(anchors.select("a", F.col("vec_id").alias("anchor_id")), "a") \
        .select("anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"))
