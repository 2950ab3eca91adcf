"""Substring deduplication over words: seeds from winnowed anchors, extended both ways.

Every run of ``SPAN`` words picks as its anchor the ``GRAM``-gram in it with the
smallest hash (the leftmost of equals). So all occurrences of one run, in
whatever document, have the same anchor at the same place, and it is enough to
look at documents that share an anchor. An anchor occurrence stands for the
stretch of neighbouring runs that picked it; its context is the words that these
runs cover, up to ``2 * SPAN - GRAM``.

Occurrences with an equal context agree in all their runs: the first document
keeps them, later ones lose them (one aggregate and one join, however many
documents share it). Where an anchor has several contexts, only the first
document of each context is extended run by run (at each place where it has the
context), and each run is compared with the same run elsewhere. Overlapping matches are joined to maximal repeats.
Documents with equal word sequences are judged once, as one class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import gram_hashes, mix, small_batches, stored, text_of, text_slices, word_hashes

SPAN, GRAM = 50, 16


def _anchors(words: np.ndarray, at: np.ndarray):
    """Of the texts of a slice: text number, gram hash, context hash, and the
    first and last run start, of each anchor occurrence."""
    runs = gram_hashes(words, SPAN)
    if not len(runs):
        return [np.zeros(0, np.int64)] * 5
    starts = np.concatenate([np.zeros(0, np.int64), *(np.arange(i, j - SPAN + 1) for i, j in zip(at[:-1].tolist(), at[1:].tolist()) if j - i >= SPAN)])
    if not len(starts):
        return [np.zeros(0, np.int64)] * 5
    grams = gram_hashes(words, GRAM)
    view = sliding_window_view(grams, SPAN - GRAM + 1)
    anchor = np.concatenate([view[starts[i:i + 65_536]].argmin(1) for i in range(0, len(starts), 65_536)]) + starts
    text = np.searchsorted(at, starts, "right") - 1
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(text) != 0)]))
    lo, hi = starts[new], starts[np.append(new[1:], len(starts)) - 1]
    p, t = anchor[new], text[new]
    place = ((p - lo) << 32 | (hi - lo)).astype(np.uint64)
    context = mix(runs[lo] * np.uint64(3) + mix(runs[hi] + place))
    return t, grams[p].view(np.int64), context.view(np.int64), lo - at[t], hi - at[t]


def _scan(batches):
    for b in batches:
        cols = [[] for _ in range(3)]
        lists = [[] for _ in range(4)]
        counts = []
        for first, data, off in text_slices(b.column(2)):
            words, at = word_hashes(data, off, False)
            n = np.diff(at)
            has = np.flatnonzero(n)
            f = np.zeros((2, len(n)), np.uint64)
            if len(has):
                place = mix((np.arange(len(words)) - np.repeat(at[:-1], n)).astype(np.uint64))
                for k in range(2):
                    f[k, has] = np.add.reduceat(mix((words + np.uint64(k)) ^ place), at[:-1][has])
            for c, v in zip(cols, (n, f[0].view(np.int64), f[1].view(np.int64))):
                c.append(v)
            t, *found = _anchors(words, at)
            counts.append(np.bincount(t, minlength=len(n)))
            for c, v in zip(lists, found):
                c.append(v)
        if not counts:
            continue
        off = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
        n, f1, f2 = (np.concatenate(c) for c in cols)
        h, c, lo, hi = (np.concatenate(x) for x in lists)
        arrays = [b.column(0), b.column(1), pa.array(n), pa.array(f1), pa.array(f2),
                  *(pa.ListArray.from_arrays(off, pa.array(x)) for x in (h, c, lo.astype(np.int32), hi.astype(np.int32)))]
        yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "r", "n", "f1", "f2", "h", "c", "lo", "hi"])


def _runs(batches):
    """r, doc_id, text, stretches (h, lo, hi) -> r, doc_id, h, start, run hash."""
    for b in batches:
        out = [[] for _ in range(5)]
        want = b.column(3).to_pylist()
        docs, rows = b.column(1).to_pylist(), b.column(0).to_pylist()
        for first, data, off in text_slices(b.column(2)):
            words, at = word_hashes(data, off, False)
            runs = gram_hashes(words, SPAN)
            for k in range(len(off) - 1):
                for s in want[first + k]:
                    x = np.arange(s["lo"], s["hi"] + 1)
                    for c, v in zip(out, (np.full(len(x), rows[first + k]), np.full(len(x), docs[first + k]), np.full(len(x), s["h"]),
                                          x, runs[at[k] + x].view(np.int64))):
                        c.append(v)
        if out[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["r", "doc_id", "h", "at", "run"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans joined."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _cut(batches):
    """doc_id, text, spans -> doc_id, n_words, n_removed, kept."""
    for b in batches:
        rows = []
        for doc, text, spans in zip(b.column(0).to_pylist(), text_of(b.column(1)), b.column(2).to_pylist()):
            words = text.encode("utf-8", "replace").split()  # of bytes: at [\x20\x09-\x0D]
            n, gone = len(words), 0
            for a, z in reversed(merged([(x["a"], min(x["b"], n)) for x in spans or []])):
                del words[a:z]
                gone += z - a
            rows.append((doc, n, gone, b" ".join(words).decode()))
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 3 + [pa.string()])],
                                         names=["doc_id", "n_words", "n_removed", "kept"])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("r"), "text")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> (r, spans): for each row (by the hash of its id
    and text) with a repeat, spans {a, b} of word positions, end exclusive,
    whose union is covered by runs that also start in a smaller doc_id. Spans may
    overlap."""
    small_batches(docs.sparkSession)
    docs = _keyed(docs)
    found = stored(docs.select("doc_id", "r", "text").mapInArrow(
        _scan, "doc_id long, r long, n long, f1 long, f2 long, h array<long>, c array<long>, lo array<int>, hi array<int>"), "anchors")
    known = found.where(f"doc_id is not null and n >= {SPAN}")
    same = ["n", "f1", "f2"]
    classes = known.groupBy(*same).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last")
    copies = stored(known.select("doc_id", "r", *same).join(classes, same).where("doc_id != first").select("r", "n").distinct(), "copies")
    own = known.join(copies.select("r"), "r", "left_anti").dropDuplicates(["r"])
    seeds = stored(own.select("doc_id", "r", F.explode(F.arrays_zip("h", "c", "lo", "hi")).alias("x")).select("doc_id", "r", "x.*"), "seeds")
    groups = stored(seeds.groupBy("h", "c").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")), "contexts")
    several = groups.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("first").alias("d0"), F.max("first").alias("d1")) \
        .where("k > 1 and d0 != d1").select("h", F.lit(True).alias("several"))
    groups = groups.join(several, "h", "left").where("several or first != last").drop("last")
    judged = stored(seeds.join(groups, ["h", "c"]).where("several or doc_id != first")
                    .select("r", "h", "lo", "hi", (F.col("doc_id") != F.col("first")).alias("later")), "judged")
    spans = judged.where("later").select("r", F.col("lo").alias("a"), (F.col("hi") + SPAN).alias("b"))
    extend = judged.where("not later").select("r", F.struct("h", "lo", "hi").alias("s")) \
        .groupBy("r").agg(F.collect_list("s").alias("s"))  # at most as many as one text has anchors
    runs = docs.join(extend, "r").select("r", "doc_id", "text", "s").mapInArrow(_runs, "r long, doc_id long, h long, at long, run long")
    runs = stored(runs, "runs")
    shared = runs.groupBy("h", "run").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first != last")
    ext = runs.join(shared.drop("last"), ["h", "run"]).where("doc_id != first") \
        .select("r", F.col("at").cast("int").alias("a"), (F.col("at") + SPAN).cast("int").alias("b"))
    whole = copies.select("r", F.lit(0).alias("a"), F.col("n").cast("int").alias("b"))
    return spans.unionByName(ext).unionByName(whole).groupBy("r").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> doc_id, n_words,
    n_removed, kept (the words left, joined by one space), a row per row.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a run of 50 words that
    covers it also starts in a document with a smaller doc_id; runs are judged
    on the input. Null and empty texts have no words. Rows that repeat a doc_id
    are judged each, never against each other; a null doc_id is left whole and
    judges none. Empty table: empty result.
    """
    spans = repeated_spans(docs)
    return _keyed(docs).join(spans, "r", "left").select("doc_id", "text", "spans") \
        .mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")


def digests(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
