"""Phrase collocations by set-oriented relational mining (SETM).

The relation of occurrences of length k is persisted in the order of piece and
position. A row of it holds runs: the word keys of neighbouring occurrences, each
run begun by a 0, so the merge join on (piece, position + 1) pairs each occurrence
with the next one of its run, without a shuffle. The groups of k + 1 words that
come out of it are counted (summed in the task first, then by Spark), and the
occurrences are semi-joined with the frequent groups before the next length.

The semi-join uses a bitmap of the frequent groups with a fixed size of
2 ** ``BITS`` bits: it keeps every occurrence of a frequent group and few others. All
counts are exact sums over whole groups of words, so what the bitmap lets through
costs time and never changes a result.

A word key is a 64-bit hash of language and word. The exact table of words shows
whether two words share a key; then all keys are made anew with another seed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.llm.common import mix, release, scratch_paths, small_batches, stored, text_slices

LEAST, LONGEST, TOP, CONTAINED = 30, 4, 2000, 80
#: Size of the semi-join's bitmap as a power of two (8 MiB).
BITS = 26
#: Words and groups that a task sums before it hands them on, words of a stored row
#: of runs, and bytes of text and positions that a task looks at together.
HELD_WORDS, HELD, ROW_WORDS, SLICE, SPAN = 300_000, 1_500_000, 256, 400_000, 1 << 17
SALTS = 32
#: A piece ends at these, a word also at a blank or a tab.
PIECE_END, WORD_END = b".,;:!?\n\x0b\x0c\r", b" \t"

_KIND = np.zeros(256, np.uint8)
_KIND[list(WORD_END)] = 1
_KIND[list(PIECE_END)] = 2
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _byte_hashes(data: np.ndarray, starts: np.ndarray, lens: np.ndarray, at: np.ndarray, first: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each word: random byte values times powers of an odd number, summed."""
    value = np.random.default_rng([12, seed]).integers(1, 2**64, 256, dtype=np.uint64)[_LOWER]
    power = np.cumprod(np.full(int(lens.max()), _ODD, np.uint64))
    return mix(np.add.reduceat(value[data[at]] * power[np.arange(len(at)) - np.repeat(first, lens)], first) + lens.astype(np.uint64))


def words_of(texts: pa.Array, langs: list[str | None], seed: int) -> Iterator[tuple]:
    """For slices of the texts: word keys, a second hash, whether a word begins a
    piece, and where its bytes are (bytes, starts, lengths, row of the word)."""
    known: dict[str | None, int] = {}
    for row, data, off in text_slices(texts, SLICE):
        kind = _KIND[data]
        at = np.flatnonzero(kind == 0)
        if not len(at):
            continue
        begin = np.empty(len(at), bool)
        begin[0] = True
        begin[1:] = np.diff(at) > 1
        heads = np.searchsorted(at, off[:-1])
        begin[heads[heads < len(at)]] = True
        first = np.flatnonzero(begin)
        lens, starts = np.diff(np.append(first, len(at))), at[first]
        doc = np.searchsorted(off, starts, "right") - 1
        ends = np.cumsum(kind == 2)[starts]
        piece = np.ones(len(starts), bool)
        piece[1:] = (ends[1:] != ends[:-1]) | (doc[1:] != doc[:-1])
        for lang in set(langs[row:row + len(off) - 1]) - known.keys():
            name = np.frombuffer((lang or "und").encode() + b"\x00", np.uint8).astype(np.uint64)
            h = np.uint64(seed + 1)
            for b in name:
                h = mix(np.array([h ^ b]) * _ODD)[0]
            known[lang] = int(h)
        salt = np.array([known[x] for x in langs[row:row + len(off) - 1]], np.uint64)[doc]
        key = mix(_byte_hashes(data, starts, lens, at, first, 2 * seed) + salt)
        key[key == 0] = 1
        yield key, _byte_hashes(data, starts, lens, at, first, 2 * seed + 1) + salt, piece, (data, starts, lens, doc + row)


def gram_hash(*columns: np.ndarray) -> np.ndarray:
    out = mix(columns[0])
    for c in columns[1:]:
        out = mix(out * _ODD + c)
    return out


def grouped(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct rows of the columns, their summed ``n``, and a place of each."""
    order = np.argsort(gram_hash(*columns))
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(n[order], first), order[first]


def _taken(data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> pa.Array:
    """The words at these places, lower-cased."""
    off = np.concatenate([[0], np.cumsum(lens)])
    inside = np.arange(off[-1]) - np.repeat(off[:-1], lens)
    low = _LOWER[data[np.repeat(starts, lens) + inside]].astype(np.uint8)
    return pa.LargeStringArray.from_buffers(len(lens), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(low))


def _count_words(seed: int):
    """lang, text -> id, lang, word, n; one row for a word of about HELD_WORDS that a task holds."""
    def run(batches):
        parts: list[tuple] = []
        names: dict[str, int] = {}

        def summed():
            ids, check, n, lang = (np.concatenate([p[i] for p in parts]) for i in range(4))
            (ids, check), n, place = grouped([ids, check], n)
            return ids, check, n, lang[place], pa.concat_arrays([p[4] for p in parts]).take(pa.array(place))

        def batch(x):
            lang = pa.array(list(names), pa.string()).take(pa.array(x[3]))
            return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), lang, x[4].cast(pa.string()), pa.array(x[2])],
                                              names=["id", "lang", "word", "n"])
        for b in batches:
            langs = b.column(0).to_pylist()
            code = np.array([names.setdefault(x or "und", len(names)) for x in langs], np.int32)
            for key, check, _, (data, starts, lens, row) in words_of(b.column(1), langs, seed):
                (key, check), n, place = grouped([key, check], np.ones(len(key), np.int64))
                parts.append((key, check, n, code[row[place]], _taken(data, starts[place], lens[place])))
                if sum(len(p[0]) for p in parts) > HELD_WORDS:
                    parts = [summed()]
                    if len(parts[0][0]) > HELD_WORDS * 2 // 3:
                        yield batch(parts.pop())
        if parts:
            yield batch(summed())
    return run


def _holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for p in _places(h):
        out &= (bits[p >> 3] >> (p & 7).astype(np.uint8)) & 1 == 1
    return out


def _places(h: np.ndarray) -> list[np.ndarray]:
    return [(x >> np.uint64(64 - BITS)).astype(np.int64) for x in (h, h * _ODD)]


def chains(x: np.ndarray, mark: np.ndarray, k: int) -> np.ndarray:
    """The words under each stretch of two or more neighbouring marked groups of
    ``k`` words, each stretch as a run begun by a 0."""
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    start, n = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
    start, n = start[n > 1], n[n > 1]
    size = n + k
    ends = np.cumsum(size)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
    out = x[np.repeat(start, size) + np.maximum(inside - 1, 0)]
    out[inside == 0] = 0
    return out


def _rows(x: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Runs as rows of about ROW_WORDS words; a run is never cut."""
    if not len(x):
        return
    zero = np.flatnonzero(x == 0)
    off = np.append(zero[np.flatnonzero(np.diff(zero // ROW_WORDS, prepend=-1))], len(x))
    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(x.view(np.int64)))], names=["runs"])


def _first_runs(seed: int, frequent):
    def run(batches):
        bits = np.frombuffer(frequent.value, np.uint8)
        for b in batches:
            for key, _, piece, _ in words_of(b.column(1), b.column(0).to_pylist(), seed):
                x = np.insert(key, np.flatnonzero(piece), 0)
                yield from _rows(chains(x, (x != 0) & _holds(bits, gram_hash(x)), 1))
    return run


def _grams(x: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Merge join of the relation with itself at adjacent positions, a span at a
    time: where a group of ``k`` words begins, and the groups' words."""
    for begin in range(0, len(x) - k + 1, SPAN):
        n = min(SPAN, len(x) - k + 1 - begin)
        at = begin + np.flatnonzero(np.logical_and.reduce([x[begin + i:begin + i + n] != 0 for i in range(k)]))
        if len(at):
            yield at, [x[at + i] for i in range(k)]


def _flat(b: pa.RecordBatch) -> np.ndarray:
    return b.column(0).flatten().to_numpy().view(np.uint64)


def _count_grams(k: int):
    """runs -> w0..w(k-1), n."""
    def run(batches):
        parts: list[tuple] = []

        def summed():
            words, n, _ = grouped([np.concatenate([p[0][i] for p in parts]) for i in range(k)], np.concatenate([p[1] for p in parts]))
            return words, n

        def batch(x):
            return pa.RecordBatch.from_arrays([*(pa.array(w.view(np.int64)) for w in x[0]), pa.array(x[1])], names=[*(f"w{i}" for i in range(k)), "n"])
        for b in batches:
            for at, words in _grams(_flat(b), k):
                parts.append((words, np.ones(len(at), np.int64)))
                if sum(len(p[1]) for p in parts) > HELD:
                    words, n = summed()
                    parts = [(words, n)]
                    if len(n) > HELD * 2 // 3:  # the frequent ones stay: they go on growing
                        often = np.zeros(len(n), bool)
                        often[np.argpartition(n, -len(n) // 4)[-len(n) // 4:]] = True
                        yield batch(([w[~often] for w in words], n[~often]))
                        parts = [([w[often] for w in words], n[often])]
        if parts:
            yield batch(summed())
    return run


def _next_runs(k: int, frequent):
    """Semi-join of the groups of ``k`` words with the frequent ones; what is left, as runs."""
    def run(batches):
        bits = np.frombuffer(frequent.value, np.uint8)
        for b in batches:
            x = _flat(b)
            mark = np.zeros(len(x), bool)
            for at, words in _grams(x, k):
                mark[at[_holds(bits, gram_hash(*words))]] = True
            yield from _rows(chains(x, mark, k))
    return run


def _bit_places(batches):
    for b in batches:
        words = [c.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in b.columns]
        if b.num_rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(_places(gram_hash(*words))))], names=["p"])


def _bitmap(groups: DataFrame):
    """Broadcast bitmap of the groups' hashes, 2 ** BITS bits at any number of groups."""
    sc, block = groups.sparkSession.sparkContext, 1 << 15
    parts = groups.mapInArrow(_bit_places, "p long").groupBy((F.col("p") / block).cast("long").alias("part")) \
        .agg(F.expr(f"bitmap_construct_agg(p % {block})").alias("bits"))
    bits = np.zeros(1 << BITS - 3, np.uint8)
    for part, x in parts.collect():
        bits[part * block // 8:(part + 1) * block // 8] = np.frombuffer(x, np.uint8)
    return sc.broadcast(bits.tobytes())


def _word_table(rows: DataFrame) -> tuple[int, DataFrame]:
    """The seed and (id, lang, word, n) of all words, no two words with one id."""
    seed = 0
    while True:
        words = stored(rows.mapInArrow(_count_words(seed), "id long, lang string, word string, n long")
                       .groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if not words.groupBy("id").count().where("count > 1").take(1):
            return seed, words
        seed += 1


def frequent_groups(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``docs`` (lang, text) -> all words (id, lang, word, n), and all groups of one to
    ``longest`` adjacent words that occur at least ``least`` times (words: their ids, n)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    seed, words = _word_table(rows)
    many = words.where(F.col("n") >= least)
    found = [many.select(F.array("id").alias("words"), "n")]
    bits, runs, used = _bitmap(many.select("id")), rows, []
    for k in range(2, longest + 1):
        step = _first_runs(seed, bits) if k == 2 else _next_runs(k - 1, bits)
        runs = stored(runs.mapInArrow(step, "runs array<long>"), f"runs{k}")
        release(docs.sparkSession, used)
        used = scratch_paths()[-1:]
        bits.unpersist()
        cols = [f"w{i}" for i in range(k)]
        groups = runs.mapInArrow(_count_grams(k), ", ".join(f"{c} long" for c in [*cols, "n"])).groupBy(*cols).agg(F.sum("n").alias("n"))
        groups = stored(groups.where(F.col("n") >= least), f"groups{k}")
        found.append(groups.select(F.array(*cols).alias("words"), "n"))
        if k < longest:
            bits = _bitmap(groups.select(cols))
    release(docs.sparkSession, used)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return words, out


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, contained: int = CONTAINED) -> DataFrame:
    """``docs`` (lang, text; other columns are ignored) -> lang, rank, phrase, a, l, r,
    n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    a, l, r count the phrase and both parts of its lowest-scoring cut, n all words of the
    language; the score is floor(2000000 a / (l + r)). A phrase that lies inside a longer
    frequent one with at least ``contained`` % of its count is dropped. Null texts
    are empty, a null lang is ``und``; rows that repeat count again; equal scores and
    counts go by the phrase's bytes. Texts without words add nothing; an empty table
    gives no rows.
    """
    words, groups = frequent_groups(docs, least, longest)
    n = words.groupBy("lang").agg(F.sum("n").alias("all"))
    phrase = stored(groups.where(F.size("words") > 1).select("words", F.col("n").alias("a")), "candidates")
    big = lambda c: F.col(c).cast("decimal(38,0)")
    inner = phrase.where(F.size("words") > 2).select("a", "words", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("m"))
    inner = inner.select("a", F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - F.col("m") + 1),
                                                    lambda i: F.slice("words", i, F.col("m")))).alias("words"))
    over = inner.groupBy("words").agg(F.max("a").alias("outer"))
    left = phrase.join(over, "words", "left").where(F.col("outer").isNull() | (100 * big("outer") < contained * big("a"))).drop("outer")
    cut = left.select("words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.slice("words", F.lit(1), F.col("k")).alias("part")),
                    F.struct(F.lit(1).alias("side"), F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("part")))
    parts = cut.select("words", "a", "k", F.explode(sides).alias("x")).select("words", "a", "k", "x.side", F.col("x.part").alias("part"))
    parts = parts.join(groups.select(F.col("words").alias("part"), F.col("n").alias("f")), "part")
    cuts = parts.groupBy("words", "a", "k").agg(F.sum(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
                                                F.sum(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    score = F.expr("(2000000 * CAST(a AS DECIMAL(31,0))) div (CAST(l AS DECIMAL(38,0)) + r)")
    best = cuts.groupBy("words", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b")).select("words", "a", "b.l", "b.r", "b.score")
    name = words.where(F.col("n") >= least).select("id", "lang", "word")
    best = best.withColumn("id", F.col("words")[0]).join(name.drop("word"), "id").drop("id")
    # the best of each language without its texts (ties stay), in shares first: a language may hold most phrases
    order = [F.desc("score"), F.desc("a")]
    for share in (["lang", F.pmod(F.xxhash64("words"), F.lit(SALTS))], ["lang"]):
        best = best.withColumn("place", F.rank().over(Window.partitionBy(*share).orderBy(*order))).where(F.col("place") <= top).drop("place")
    best = stored(best, "best")
    said = best.select("words", F.posexplode("words").alias("i", "id")).join(name.drop("lang"), "id") \
        .groupBy("words").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return best.join(said, "words").join(n, "lang").withColumn("rank", place.cast("long")).where(F.col("rank") <= top) \
        .select("lang", "rank", "phrase", "a", "l", "r", F.col("all").alias("n"), "score")
