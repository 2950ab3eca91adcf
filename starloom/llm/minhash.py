"""MinHash near-duplicates by a chosen-path set similarity join.

A document's set holds the 64-bit hashes of its distinct five-word shingles.
Documents with equal sets form a class; the smallest id stands for it. Each of
``TREES`` trees branches every representative by minwise values: a node picks
some of the ``COORDS`` minwise functions (1 / threshold of them on average: at
0.85, one or two) by a hash of its path, and a document goes to the child that its
minwise value names. Nodes of up to ``SMALL`` documents are compared
exhaustively; larger ones branch on for as long as that shrinks them.

What stays large then is a group of documents that share most of their minwise
values, such as thousands of near copies. Each such node first compares all
members with one leader, and the links found so far are turned into components.
Members that are connected already need no further comparison; those outside
the node's largest component are compared with all members, in blocks. So a
group of near copies costs a few passes over its members, and nothing is capped.

Every link is confirmed on the full sets. In small nodes two bounds go before
it: set sizes (exact), and one-bit minwise agreement, which loses a pair at the
threshold with a probability of at most ``LOST``. Branching and sketch bound follow
the threshold. A pair at 0.85 (0.80) misses all small first-level nodes with a
probability under 1e-9; at depth three, the trees together find it with over 0.999.
"""

from __future__ import annotations

from functools import cache, reduce
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import gram_hashes, mix, small_batches, stored, text_slices, word_hashes
from starloom.llm.components import components

SHINGLE, COORDS, TREES, SMALL, DEPTH = 5, 64, 12, 32, 8
#: A level is branched again if it left under SHRINK of the rows of large nodes; about as many hashes make a block of a node.
SHRINK, BLOCK = 0.6, 1_000_000
#: Probability at most with which the one-bit sketches of a pair at the threshold differ too much.
LOST = 4e-6
_rng = np.random.default_rng(7)
_A = _rng.integers(1, 2**63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 2**64, COORDS, dtype=np.uint64)


@cache
def bits_apart(percent: int) -> int:
    """Bits that two one-bit sketches of COORDS bits may differ in: the least bound
    that loses a pair at ``percent`` with at most LOST. A bit differs with half the
    probability that the minwise values do."""
    p, over = (1 - percent / 100) / 2, 1.0
    for bits in range(COORDS + 1):
        over -= comb(COORDS, bits) * p**bits * (1 - p)**(COORDS - bits)
        if over <= LOST:
            break
    return bits


def shingle_sets(column: pa.Array, lower: bool = True):
    """Yield each text's sorted distinct shingle hashes; words are
    ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. Fewer words than a shingle:
    the whole sequence is one; no word (null, empty): no element."""
    for _, data, off in text_slices(column):
        words, at = word_hashes(data, off, lower)
        grams = gram_hashes(words, SHINGLE)
        for i, j in zip(at[:-1].tolist(), at[1:].tolist()):
            if j - i >= SHINGLE:
                yield np.unique(grams[i:j - SHINGLE + 1])
            elif j > i:
                yield gram_hashes(words[i:j], j - i)
            else:
                yield np.zeros(0, np.uint64)


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Minwise values, a row of COORDS for each non-empty set."""
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), COORDS), np.uint64)
    for c in range(COORDS):
        out[:, c] = np.minimum.reduceat((flat ^ _B[c]) * _A[c], at)
    return out


def _profile(batches):
    for b in batches:
        ids, groups, size = b.column(0), [[]], 0
        for s in shingle_sets(b.column(1)):
            if size > 200_000:
                groups.append([])
                size = 0
            groups[-1].append(s)
            size += len(s)
        row = 0
        for sets in groups:
            full = [s for s in sets if len(s)]
            n = np.array([len(s) for s in sets], np.int64)
            f1, f2, bits = (np.zeros(len(sets), np.uint64) for _ in range(3))
            raw = [None] * len(sets)
            if full:
                sk = _sketches(full)
                has = np.flatnonzero(n)
                flat, at = np.concatenate(full), np.cumsum([0] + [len(s) for s in full[:-1]])
                f1[has] = np.add.reduceat(mix(flat), at)
                f2[has] = np.add.reduceat(mix(flat ^ np.uint64(0xA5A5A5A55A5A5A5A)), at)
                one = (mix(sk) >> np.uint64(63)) << np.arange(COORDS, dtype=np.uint64)
                bits[has] = np.bitwise_or.reduce(one, axis=1)
                short = (sk >> np.uint64(32)).astype("<u4")
                for k, i in enumerate(has.tolist()):
                    raw[i] = short[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(row, len(sets)).cast(pa.int64()), pa.array(n), *(pa.array(x.view(np.int64)) for x in (f1, f2, bits)),
                 pa.array(raw, pa.binary())], names=["doc_id", "n", "f1", "f2", "bits", "sketch"])
            row += len(sets)


def _children(keys: np.ndarray, sketches: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row index, child key) of every branch: a node picks its coordinates by
    a hash of its own key, 1 / threshold of them on average: one always, a second
    with 1 / threshold - 1 (under one half, a second always and so on)."""
    sk, out_i, out_k = sketches.astype(np.uint64), [], []
    for turn in range(1, ceil(100 / percent) + 1):
        share = min(1.0, 100 / percent - turn + 1)
        h = mix(keys * np.uint64(2 * turn + 1) + np.uint64(turn))
        at = np.flatnonzero((h >> np.uint64(40)).astype(np.float64) / 2**24 < share)
        c = (h[at] % np.uint64(COORDS)).astype(np.int64)
        out_i.append(at)
        out_k.append(mix(keys[at] * np.uint64(0x9E3779B97F4A7C15) ^ mix((sk[at, c] << np.uint64(8)) + c.astype(np.uint64))))
    return np.concatenate(out_i), np.concatenate(out_k)


def _branch(percent: int):
    """Columns key, doc, n, bits, sketch -> the same rows in child nodes; a
    null key stands for the roots of all trees."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sk = np.frombuffer(b"".join(b.column(4).to_pylist()), "<u4").reshape(-1, COORDS)
            key = b.column(0)
            if key.null_count:
                keys = mix(np.tile(np.arange(1, TREES + 1, dtype=np.uint64), len(sk)))
                src = np.repeat(np.arange(len(sk)), TREES)
            else:
                keys, src = key.to_numpy().view(np.uint64), np.arange(len(sk))
            i, child = _children(keys, sk[src], percent)
            rows = pa.array(src[i])
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), *(b.column(k).take(rows) for k in (1, 2, 3))],
                                             names=["key", "doc", "n", "bits"])
    return run


def _sets(batches):
    for b in batches:
        sets = list(shingle_sets(b.column(1)))
        flat = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
        off = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.ListArray.from_arrays(off, pa.array(flat))],
                                         names=["doc", "set"])


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs within each (bounded) small node that the two bounds let pass."""
    groups = rows.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "doc", "bits"))).alias("g"))
    one = groups.select("g", F.posexplode("g").alias("i", "x"))
    two = one.select("x", F.explode(F.expr(f"slice(g, i + 2, {SMALL})")).alias("y"))
    ok = (F.col("x.doc") != F.col("y.doc")) & (100 * F.col("x.n") >= percent * F.col("y.n")) \
        & (F.bit_count(F.col("x.bits").bitwiseXOR(F.col("y.bits"))) <= bits_apart(percent))
    return two.where(ok).select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    left = sets.select(F.col("doc").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("doc").alias("b"), F.col("set").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", both.alias("i"), (F.size("sa") + F.size("sb") - both).alias("u"))
            .where(f"100L * i >= {percent}L * u").select("a", "b"))


def _block_links(percent: int):
    """Compare the askers of a block with its members on their sets; a spanning
    forest of the links is enough."""
    def run(pdf):
        pdf = pdf.sort_values("doc", kind="stable").reset_index(drop=True)
        ask, doc, label = (pdf[c].to_numpy() for c in ("ask", "doc", "label"))
        n = np.array([len(x) for x in pdf["set"]])
        flat, ids = np.unique(np.concatenate(list(pdf["set"])), return_inverse=True)
        at = np.concatenate([[0], np.cumsum(n)])
        mark = np.zeros(len(flat), np.int32)
        root = {x: x for x in label.tolist()}

        def top(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        out, base = [], np.flatnonzero(~ask)
        if len(base):
            lists = np.concatenate([ids[at[k]:at[k + 1]] for k in base.tolist()])
            starts = np.concatenate([[0], np.cumsum(n[base])[:-1]])
            for k in np.flatnonzero(ask).tolist():
                mark[ids[at[k]:at[k + 1]]] = 1
                both = np.add.reduceat(mark[lists], starts)
                mark[ids[at[k]:at[k + 1]]] = 0
                for m in base[100 * both >= percent * (n[k] + n[base] - both)].tolist():
                    x, y = top(label[k]), top(label[m])
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        out.append((doc[k], doc[m]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")
    return run


def _rest(big: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join components within large nodes. ``big`` (key, doc, n)."""
    rows = big.join(labels.withColumnRenamed("id", "doc"), "doc", "left") \
        .select("key", "doc", "n", F.coalesce("component", "doc").alias("label"))
    rows = stored(rows, "rest")
    count = rows.groupBy("key", "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"),
                                             F.sum(F.xxhash64("doc").cast("decimal(38,0)")).alias("f"))
    nodes = count.groupBy("key").agg(F.max(F.struct("c", "label", "n")).alias("top"), F.sum("c").alias("m"), F.sum("n").alias("n"),
                                     F.sum("f").alias("f")).where("top.c < m")
    nodes = nodes.groupBy("f", "m").agg(F.min_by(F.struct("key", "top", "n"), "key").alias("k")) \
        .select("k.key", F.col("k.top.label").alias("main"), F.ceil(F.col("k.n") / BLOCK).cast("int").alias("nb"),
                F.ceil((F.col("k.n") - F.col("k.top.n")) / BLOCK).cast("int").alias("na"))
    rows = rows.join(nodes, "key")
    deal = lambda k: F.pmod(F.xxhash64("doc"), F.col(k)).cast("int")
    span = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    base = rows.select("key", "doc", "label", F.lit(False).alias("ask"), deal("nb").alias("j"), span("na").alias("i"))
    ask = rows.where("label != main").select("key", "doc", "label", F.lit(True).alias("ask"), deal("na").alias("i"), span("nb").alias("j"))
    return base.unionByName(ask).join(sets, "doc").groupBy("key", "i", "j").applyInPandas(_block_links(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> doc_id, n_shingles,
    component_id, kept, one row per row.

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets; component_id is the smallest doc_id reachable. Null and empty
    texts have no shingle and link with nothing. Rows that repeat a doc_id are
    each returned; a link of one holds for the id. A null doc_id has no identity:
    its row is returned with a null component, kept. Empty table: empty result.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    prof = stored(docs.mapInArrow(_profile, "doc_id long, n long, f1 long, f2 long, bits long, sketch binary"), "profile")
    known = prof.where("n > 0 and doc_id is not null")
    classes = known.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep"))
    heads = classes.select("f1", "f2", F.col("rep").alias("doc_id"))
    reps = known.join(heads, ["f1", "f2", "doc_id"]).select(F.col("doc_id").alias("doc"), "n", "bits", "sketch")
    rows = reps.select(F.lit(None).cast("long").alias("key"), "doc", "n", "bits", "sketch")
    pairs, left, big = [], None, None
    for depth in range(1, DEPTH + 1):
        rows = stored(rows.mapInArrow(_branch(percent), "key long, doc long, n long, bits long"), "nodes")
        count = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        live = rows.join(count, "key")
        pairs.append(_pairs(live.where(F.col("c") <= SMALL), percent))
        big, before = stored(live.where(F.col("c") > SMALL).drop("c"), "big"), left
        left = big.count()
        if not left or before is not None and left >= SHRINK * before:
            break
        rows = big.join(reps.select("doc", "n", "sketch"), ["doc", "n"]).select("key", "doc", "n", "bits", "sketch")
    if left:
        lead = big.groupBy("key").agg(F.min_by("doc", F.xxhash64("key", "doc")).alias("head"))
        pairs.append(big.join(lead, "key").where("doc != head").select(F.least("doc", "head").alias("a"), F.greatest("doc", "head").alias("b")))
    pairs = stored(reduce(DataFrame.unionByName, pairs).distinct(), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    ids = ids.unionByName(big.select(F.col("doc").alias("doc_id"))).distinct()
    # merge: the same plan at every size; the ids grow with the table
    sets = stored(docs.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(_sets, "doc long, set array<long>"), "sets")
    labels = stored(components(_confirmed(pairs, sets, percent)), "labels")
    if left:
        links = labels.select(F.col("id").alias("a"), F.col("component").alias("b"))
        labels = stored(components(links.unionByName(_rest(big.select("key", "doc", "n"), labels, sets, percent))), "labels")
    out = prof.join(classes, ["f1", "f2", "n"], "left").select(
        "doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"))
    out = out.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    root = F.coalesce("component", "rep")
    return out.select("doc_id", F.col("n").alias("n_shingles"), root.alias("component_id"),
                      root.eqNullSafe(F.col("doc_id")).alias("kept"))
