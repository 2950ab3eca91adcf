"""Embedding near-duplicates by E8 lattice hashing.

In each of some tables a vector's direction is projected at random to
``BLOCKS`` times eight dimensions, and each eight are decoded to the nearest
point of the E8 lattice; the points together name the vector's home cell. It
also probes the ``PROBES`` neighbouring cells (one block moved by one of the 240
shortest lattice vectors) that are nearest to its projection. Two vectors meet
where one's home is the other's home or probe; their cosine is then computed.

How fine the lattice is follows the number of vectors (``fineness``). Unrelated vectors
meet in a table with ``UNRELATED`` at the scale ``SCALE`` and with the sixteenth power of
its inverse at others (two blocks of eight dimensions, cells of volume one), so the
scale grows with the sixteenth root of the collection and a vector goes on meeting
about ``MEETS`` unrelated ones in a table (at that number, pairs cost about as much as
the table's keys). Links meet more rarely in finer cells: the rate at the
threshold is measured on random pairs, and there are as many tables as keep the chance
to miss such a link in all of them under ``MISS``.

Small cells are compared pair by pair. Cells with more than ``SMALL`` vectors are
first compared with one leader; members outside the cell's largest component are
then compared with all others in blocks. All links lie within components, so
their number is counted there, in blocks, without listing them.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import mix, small_batches, stored
from starloom.llm.components import components

BLOCKS, SCALE, PROBES, SMALL, BLOCK = 2, 0.6, 8, 32, 1024
UNRELATED, MEETS, MISS = 4.5e-5, 1, 1e-5


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    return np.array(out + [np.array(s) for s in product((0.5, -0.5), repeat=8) if np.prod(s) > 0])


SHORTEST = _shortest()


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest point with whole coordinates of an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: D8, or D8 moved by a half."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def cells(x: np.ndarray, tables: int, blocks: int = BLOCKS, scale: float = SCALE, probes: int = PROBES):
    """For unit rows: (table, n x (1 + probes) cell keys, home first)."""
    for t in range(tables):
        rng = np.random.default_rng([t, x.shape[1]])
        w = (x @ rng.normal(size=(x.shape[1], 8 * blocks)) * scale).reshape(-1, 8)
        home = decode(w)
        near = ((w - home) @ SHORTEST.T).reshape(len(x), -1)
        top = np.argpartition(-near, probes, axis=1)[:, :probes]
        points = np.repeat((2 * home).astype(np.int64).reshape(len(x), 1, blocks, 8), 1 + probes, axis=1)
        rows = np.arange(len(x))
        for k in range(probes):
            points[rows, k + 1, top[:, k] // 240] += (2 * SHORTEST[top[:, k] % 240]).astype(np.int64)
        key = np.full(points.shape[:2], t + 1 + 1000 * x.shape[1], np.uint64)
        for c in range(8 * blocks):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + points.reshape(len(x), 1 + probes, -1)[:, :, c].astype(np.uint64))
        yield t, key.view(np.int64)


def met(x: np.ndarray, y: np.ndarray, tables: int, scale: float) -> np.ndarray:
    """In which tables (columns) the pairs of rows meet: the home of one is the home or a probe of the other."""
    both = zip(cells(x, tables, scale=scale), cells(y, tables, scale=scale))
    return np.column_stack([(a == b[:, :1]).any(1) | (b == a[:, :1]).any(1) for (_, a), (_, b) in both])


def pairs_at(cosine: float, n: int, dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors, and others at exactly this cosine to them."""
    x, y = np.random.default_rng(seed).normal(size=(2, n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y /= np.linalg.norm(y, axis=1)[:, None]
    return x, cosine * x + np.sqrt(1 - cosine * cosine) * y


def fineness(n: int, cosine: float) -> tuple[float, int]:
    """Scale and number of tables for ``n`` different vectors (see above)."""
    scale = SCALE * max(1.0, n * UNRELATED / MEETS) ** (1 / (8 * BLOCKS))
    rate = float(met(*pairs_at(cosine, 2000, 64, 1), 4, scale).mean())
    return scale, max(1, int(np.ceil(np.log(MISS) / np.log1p(-min(max(rate, 1e-4), 0.99)))))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _keys(scale: float, tables: int):
    """id, unit vector -> key, id, home."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            dims = np.diff(b.column(1).offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                x = _matrix(b.column(1).take(pa.array(at)), dim)
                ids = b.column(0).to_numpy()[at]
                for _, key in cells(x, tables, scale=scale):
                    home = np.zeros(key.shape, bool)
                    home[:, 0] = True
                    yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(np.repeat(ids, key.shape[1])), pa.array(home.ravel())],
                                                     names=["key", "id", "home"])
    return run


def _groups(batches, keys: int):
    """Rows of one key (the first columns) together, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.column_stack([b.column(i).to_numpy() for i in range(keys)])
        cut = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), b.num_rows]
        for i, j in zip(cut, cut[1:]):
            now = tuple(k[i].tolist())
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(i, j - i))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _vectors(t: pa.Table) -> np.ndarray:
    col = t.column("v").combine_chunks()
    return _matrix(col, len(col[0]))


def _rest_links(least: float):
    """key, i, j, id, label, ask, v: askers against members; a spanning forest."""
    def run(batches):
        for t in _groups(batches, 3):
            ask = t.column("ask").to_numpy(zero_copy_only=False).astype(bool)
            ids, label, x = t.column("id").to_numpy(), t.column("label").to_numpy(), _vectors(t)
            a, m = np.flatnonzero(ask), np.flatnonzero(~ask)
            if not len(a) or not len(m):
                continue
            near = x[a] @ x[m].T >= least
            near &= label[a][:, None] != label[m][None, :]
            rows, cols = [], []
            for k in np.flatnonzero(near.any(1)).tolist():  # one link for each other component
                hit = np.flatnonzero(near[k])
                _, first = np.unique(label[m][hit], return_index=True)
                rows += [ids[a[k]]] * len(first)
                cols += ids[m[hit[first]]].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(cols, pa.int64())], names=["a", "b"])
    return run


def _counted(least: float):
    """component, i, j, id, block, size, v -> id, n: linked vectors in the pair of blocks."""
    def run(batches):
        for t in _groups(batches, 3):
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            ids, block, size = (t.column(c).to_numpy() for c in ("id", "block", "size"))
            x = _vectors(t)
            a, m = np.flatnonzero(block == i), np.flatnonzero(block == j)
            near = x[a] @ x[m].T >= least
            if i == j:
                np.fill_diagonal(near, False)
                out, n = ids[a], near @ size[m]
            else:
                out, n = np.concatenate([ids[a], ids[m]]), np.concatenate([near @ size[m], near.T @ size[a]])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64()), pa.array(n, pa.int64())], names=["id", "n"])
    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, scale: float | None = None, tables: int | None = None) -> DataFrame:
    """``vectors`` (vec_id, embedding; other columns are ignored) -> vec_id,
    n_links, component_id, kept, a row per row.

    Vectors that are null, empty, zero or hold null or non-finite components link
    with nothing, nor do vectors of different lengths. Equal vectors are one class
    (each links with the others). Rows that repeat a vec_id are linked vectors if
    their vectors are; a null vec_id has no identity: its row gets no links and a
    null component and is kept. Empty table: empty result. ``scale`` and ``tables`` follow
    the number of different vectors unless both are given.
    """
    small_batches(vectors.sparkSession)
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    norm = F.sqrt(F.aggregate("e", F.lit(0.0), lambda a, x: a + x * x))
    big = F.aggregate("e", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    # scaled first, so that neither large nor small components overflow
    v = v.withColumn("m", big).withColumn("ok", F.coalesce(
        (F.col("vec_id").isNotNull()) & (F.col("m") > 0) & (F.col("m") < float("inf")) & ~F.isnan("m")
        & ~F.exists("e", lambda x: x.isNull() | F.isnan(x)), F.lit(False)))
    v = v.withColumn("e", F.when(F.col("ok"), F.transform("e", lambda x: x / F.col("m")))).withColumn("l", norm)
    v = stored(v.select("vec_id", "ok", F.when(F.col("ok"), F.transform("e", lambda x: x / F.col("l"))).alias("v"),
                        F.xxhash64(F.col("e"), F.col("m")).alias("f1"), F.hash(F.col("e")).alias("f2")), "vectors")
    good = v.where("ok")
    classes = stored(good.groupBy("f1", "f2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.first("v").alias("v")), "classes")
    reps = classes.select(F.monotonically_increasing_id().alias("id"), "f1", "f2", "rep", "size", "v")
    reps = stored(reps, "reps")
    if scale is None or tables is None:
        scale, tables = fineness(reps.count(), cosine)
    found = stored(reps.select("id", "v").mapInArrow(_keys(scale, tables), "key long, id long, home boolean"), "cells")
    count = found.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("home").alias("h")).where("c > 1 and h").select("key", "c")
    live = stored(found.join(count, "key"), "live")
    small = live.where(F.col("c") <= SMALL).groupBy("key").agg(F.collect_list(F.struct("id", "home")).alias("g"))
    two = small.select("g", F.explode(F.filter("g", lambda x: x["home"])).alias("x")).select("x", F.explode("g").alias("y"))
    pairs = two.where("x.id != y.id").select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    big = live.where(F.col("c") > SMALL)
    lead = big.groupBy("key").agg(F.min_by("id", F.xxhash64("key", "id")).alias("head"))
    stars = big.join(lead, "key").where("id != head").select(F.least("id", "head").alias("a"), F.greatest("id", "head").alias("b"))
    pairs = stored(pairs.unionByName(stars).distinct(), "pairs")
    unit = reps.select("id", "v")
    dot = F.aggregate(F.zip_with("va", "vb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    links = pairs.join(unit.select(F.col("id").alias("a"), F.col("v").alias("va")), "a") \
        .join(unit.select(F.col("id").alias("b"), F.col("v").alias("vb")), "b").where(F.size("va") == F.size("vb")) \
        .where(dot >= cosine).select("a", "b")
    labels = stored(components(links), "labels")
    rows = stored(big.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("label")).distinct(), "rest")
    nodes = rows.groupBy("key", "label").count().groupBy("key").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("m")) \
        .where("top.count < m").select("key", F.col("top.label").alias("main"), F.ceil(F.col("m") / BLOCK).cast("int").alias("nb"),
                                       F.ceil((F.col("m") - F.col("top.count")) / BLOCK).cast("int").alias("na"))
    rows = rows.join(nodes, "key")
    deal = lambda k: F.pmod(F.xxhash64("id"), F.col(k)).cast("int")
    span = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    base = rows.select("key", deal("nb").alias("j"), span("na").alias("i"), "id", "label", F.lit(0).alias("ask"))
    ask = rows.where("label != main").select("key", deal("na").alias("i"), span("nb").alias("j"), "id", "label", F.lit(1).alias("ask"))
    block = base.unionByName(ask).join(unit, "id").select("key", "i", "j", "id", "label", "ask", "v")
    more = block.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_rest_links(cosine), "a long, b long")
    labels = stored(components(more.unionByName(labels.select(F.col("id").alias("a"), F.col("component").alias("b")))), "labels")
    # all links lie within components: count them there
    sized = labels.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("nb"))
    member = labels.join(sized, "component").withColumn("block", deal("nb")).withColumn("other", span("nb"))
    member = member.select("component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "id", "block") \
        .join(reps.select("id", "size", "v"), "id").select("component", "i", "j", "id", "block", "size", "v")
    n = member.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j") \
        .mapInArrow(_counted(cosine), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    first = labels.join(reps.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("component_id"))
    full = labels.join(first, "component").select("id", "component_id").join(n, "id")
    full = reps.select("id", "f1", "f2", "rep", "size").join(full, "id", "left") \
        .select("f1", "f2", (F.col("size") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"),
                F.lit(True).alias("ok"))
    out = v.join(full, ["f1", "f2", "ok"], "left")
    root = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"),
                      root.eqNullSafe(F.col("vec_id")).alias("kept"))
