"""Sharding, collocations and hard negatives against plain versions on small rows."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from test_operators import prose, rows_of

from starloom.llm import collocation, negatives, sharding
from starloom.llm.collocation import collocations, frequent_groups
from starloom.llm.negatives import hard_negatives
from pyspark.sql import functions as F


# ---- sharding

def docs_with_copies():
    rng = random.Random(4)
    docs = [(i, prose(i, rng.randint(0, 60))) for i in range(300)] + [(300 + i, "copy of one text") for i in range(200)]
    return docs + [(i, None) for i in range(500, 560)] + [(None, "no id"), (None, "no id"), (7, docs[7][1]), (600, prose(1, 4000)), (601, "é" * 50), (602, "")]


def test_shards_are_near_equal_and_whole(spark, frame):
    docs = docs_with_copies()
    out = rows_of(sharding.assign(frame(docs), shards=8, ranges=16))
    size = {}
    assert Counter((d, n, c) for d, n, c, *_ in out) == Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in docs)
    slots = {}
    for _, n, _, law, shard, slot, grown in out:
        assert law == "bytes" and grown is None and 0 <= shard < 8
        size[shard] = size.get(shard, 0) + n
        slots.setdefault(shard, []).append(slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    total = sum(size.values())
    largest = max(n for _, n, *_ in out)
    assert all(abs(s - total / 8) <= largest + total / 8 / sharding.WHOLE for s in size.values())
    # the same whatever the ranges, but for rows that repeat
    again = rows_of(sharding.assign(frame(docs), shards=8, ranges=3, samples=2))
    assert Counter(r[:5] for r in again) == Counter(r[:5] for r in out)


def test_small_groups_of_equal_texts_stay_together(frame):
    docs = [(i, f"text {i // 2} " + "x" * 40) for i in range(4000)]
    where = {}
    for d, _, _, _, shard, *_ in rows_of(sharding.assign(frame(docs), shards=5, ranges=16)):
        where.setdefault(d // 2, set()).add(shard)
    assert all(len(s) == 1 for s in where.values())


def test_overfull_ranges_are_subdivided(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") < 12_000, 5).otherwise(F.col("id")).alias("key"), F.lit(1).cast("long").alias("id"),
                                      F.col("id").alias("__row"), F.lit(16).cast("long").alias("size")).withColumn("weight", F.lit(1 / 20_000))
    _, sums = sharding._ranges(rows, 16, 1)  # one sample for each range: some begin overfull
    got = [(r["weight"] - r["heaviest"], r["rows"]) for r in sums.collect()]
    assert sum(n for _, n in got) == 20_000 and max(w for w, _ in got) <= 2 / 16


def test_sharding_of_few_or_no_rows(frame):
    assert rows_of(sharding.assign(frame([]))) == []
    assert sharding.assign(frame([])).columns == sharding.assign(frame([(1, "a")])).columns
    assert [(r[0], r[5]) for r in rows_of(sharding.assign(frame([(1, None)])))] == [(1, 0)]
    assert sorted(r[0] for r in rows_of(sharding.assign(frame([(1, "a"), (2, "b")]), shards=1))) == [1, 2]


def test_written_shards_hold_whole_texts(spark, frame, tmp_path):
    docs = docs_with_copies()
    sharding.write_shards(frame(docs).withColumn("shard", F.lit("clash")), str(tmp_path / "out"), shards=4, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r["doc_id"], r["text"], r["key"]) for r in back.collect()) == Counter((d, t, 7) for d, t in docs)
    got = {(r["doc_id"], r["shard"], r["slot"]) for r in back.collect() if r["doc_id"] not in (None, 7)}
    want = {(r[0], r[4], r[5]) for r in rows_of(sharding.assign(frame(docs), shards=4)) if r[0] not in (None, 7)}
    assert got == want


# ---- collocations

def collocations_by_hand(docs, least, longest, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= least}
    dead = set()
    for (lang, g), a in cand.items():
        for m in range(2, len(g)):
            for i in range(len(g) - m + 1):
                if 100 * a >= 80 * cand[lang, g[i:i + m]]:
                    dead.add((lang, g[i:i + m]))
    out = []
    for lang in n:
        found = []
        for (x, g), a in cand.items():
            if x == lang and (x, g) not in dead:
                score, _, left, r = min((2_000_000 * a // (f[x, g[:k]] + f[x, g[k:]]), k, f[x, g[:k]], f[x, g[k:]]) for k in range(1, len(g)))
                found.append((-score, -a, " ".join(g).encode(), left, r))
        out += [(lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for i, (s, a, p, left, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def some_prose():
    rng = random.Random(8)
    vocabulary = ["alpha", "Beta", "gamma", "délta", "eps", "ÉTA", "x" * 300, "日本", "a", "b"]
    docs = [(rng.choice(("en", "de", None, "und")), "".join(rng.choice(vocabulary) + rng.choice((" ", " ", " ", "\t ", ", ", ".\n", "\r"))
                                                          for _ in range(rng.randint(0, 60)))) for _ in range(150)]
    return docs + [("en", None), ("en", ""), ("fr", " \t.,"), ("en", "one two three four five " * 3000), docs[0], docs[0]]


@pytest.mark.parametrize("least,top", [(3, 2000), (8, 5)])
def test_collocations_by_brute_force(frame, least, top):
    docs = some_prose()
    df = frame([(i, *d) for i, d in enumerate(docs)], ("doc_id", "lang", "text"), ("long", "string", "string")).withColumn("words", F.lit(1))
    assert sorted(rows_of(collocations(df, least=least, top=top))) == collocations_by_hand(docs, least, 4, top)


def test_collocations_with_a_full_bitmap_tiny_spans_and_a_seed_anew(frame, monkeypatch):
    """A bitmap that lets everything through, small spans and sums, and a first seed
    under which words share keys change nothing."""
    docs = some_prose()
    monkeypatch.setattr(collocation, "HELD", 50)
    monkeypatch.setattr(collocation, "HELD_WORDS", 10)
    monkeypatch.setattr(collocation, "SLICE", 30)
    monkeypatch.setattr(collocation, "SPAN", 7)
    monkeypatch.setattr(collocation, "ROW_WORDS", 4)
    monkeypatch.setattr(collocation, "_holds", lambda bits, h: h == h)
    table = collocation._word_table
    seeds = []

    def from_one(rows):
        seed, words = table(rows)
        seeds.append(seed)
        return seed, words
    monkeypatch.setattr(collocation, "_word_table", from_one)
    df = frame([(i, *d) for i, d in enumerate(docs)], ("doc_id", "lang", "text"), ("long", "string", "string"))
    assert sorted(rows_of(collocations(df, least=5))) == collocations_by_hand(docs, 5, 4, 2000) and seeds == [0]


def test_words_that_share_a_key_get_another_seed(spark, frame, monkeypatch):
    real = collocation._count_words

    def clash(seed):
        def run(batches):
            for b in real(seed)(batches):
                yield b if seed else b.set_column(0, "id", __import__("pyarrow").array([5] * b.num_rows, "int64"))
        return run
    monkeypatch.setattr(collocation, "_count_words", clash)
    seed, words = collocation._word_table(frame([(1, "en", "a b a")], ("doc_id", "lang", "text"), ("long", "string", "string")).select("lang", "text"))
    assert seed == 1 and sorted((r["word"], r["n"]) for r in words.collect()) == [("a", 2), ("b", 1)]


def test_collocations_of_nothing(frame):
    shape = (("doc_id", "lang", "text"), ("long", "string", "string"))
    assert rows_of(collocations(frame([], *shape))) == [] == rows_of(collocations(frame([(1, "en", None), (2, None, "one")], *shape)))
    words, groups = frequent_groups(frame([(1, None, "a b a b")], *shape), least=2, longest=2)
    assert sorted((r["lang"], r["word"], r["n"]) for r in words.collect()) == [("und", "a", 2), ("und", "b", 2)]
    assert sorted(r["n"] for r in groups.collect()) == [2, 2, 2]


# ---- hard negatives

def negatives_by_hand(rows, every):
    dim = max((len(v) for _, v, _ in rows if v), default=0)
    good = {(i, tuple(math.floor(256 * x) for x in v) + (0,) * (dim - len(v)), lab) for i, v, lab in rows
            if None not in (i, v, lab) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in good:
        if a[0] % every:
            continue
        score = lambda b: sum(x * y for x, y in zip(a[1], b[1]))
        by = sorted(((-score(b), b[0], b[2]) for b in good if b != a))
        for s, i, _ in [x for x in by if x[2] == a[2]][:5]:
            fit = [(-n, j) for n, j, lab in by if lab != a[2] and -30 * s <= -100 * n <= -90 * s][:10]
            out += [(a[0], i, k + 1, j, -s, n) for k, (n, j) in enumerate(fit)]
    return sorted(out)


def vectors(seed, n, dim, labels=4):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        v = [rng.gauss(0, 0.2) for _ in range(dim)]
        if i % 3 == 0:  # copies: a third of all rows has one vector
            v = [0.1] * dim
        if i % 7 == 0:  # near the axis
            v = [0.9] + [rng.gauss(0, 0.05) for _ in range(dim - 1)]
        rows.append((i, v, rng.randrange(labels)))
    rows += [(n, None, 1), (n + 1, [0.1] * dim, None), (n + 2, [None] + [0.1] * (dim - 1), 1), (n + 3, [float("nan")] * dim, 1),
             (n + 4, [float("inf")] * dim, 1), (None, [0.1] * dim, 1), (n + 5, [0.3, 0.2], 2), (n + 6, [], 3), (n + 7, [0.0] * dim, 1),
             rows[10], rows[20], (20, [0.5] * dim, 1)]
    return rows


SHAPE = (("vec_id", "embedding", "label"), ("long", "array<double>", "int"))


def negative_frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("a", F.lit(1)).withColumn("lo", F.lit("x"))


@pytest.mark.parametrize("tile,first", [(1024, 4), (16, 1)])
def test_hard_negatives_by_brute_force(spark, monkeypatch, tile, first):
    """In one tile, and over many tiles with walks of several waves."""
    monkeypatch.setattr(negatives, "TILE_ROWS", tile)
    monkeypatch.setattr(negatives, "TILE_BYTES", tile * 64)
    monkeypatch.setattr(negatives, "FIRST", first)
    monkeypatch.setattr(negatives, "GROWTH", 2)
    rows = vectors(3, 300, 8)
    got = sorted(rows_of(hard_negatives(negative_frame(spark, rows), F.col("vec_id") % 10 == 0)))
    assert got == negatives_by_hand(rows, 10)


def test_hard_negatives_beyond_double_precision(spark):
    rows = [(i, [x * 2.0**22 for x in v] if v and None not in v else v, lab) for i, v, lab in vectors(5, 60, 4)]
    got = sorted(rows_of(hard_negatives(negative_frame(spark, rows), F.col("vec_id") % 5 == 0)))
    assert got == negatives_by_hand(rows, 5) and max(abs(r[4]) for r in got) > 2**53


def test_hard_negatives_stop_early_where_bounds_allow(spark, monkeypatch):
    """Far tiles are not walked: anchors near one axis need no rows opposite to it."""
    monkeypatch.setattr(negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(negatives, "TILE_BYTES", 16 * 64)
    monkeypatch.setattr(negatives, "FIRST", 1)
    asked = []
    real = negatives.stored
    monkeypatch.setattr(negatives, "stored", lambda df, tag: (asked.append((tag, out.count())), out)[1] if (out := real(df, tag)) is not None else out)
    rng = random.Random(6)
    rows = [(i, [rng.choice((1, -1)) + rng.gauss(0, 0.01), *(rng.gauss(0, 0.3) for _ in range(3))], i % 2) for i in range(400)]
    got = sorted(rows_of(hard_negatives(negative_frame(spark, rows), F.col("vec_id") % 20 == 0)))
    assert got == negatives_by_hand(rows, 20)
    tiles = len({r for r in range(-(-400 // 20))})
    assert sum(n for t, n in asked if t == "asks") < 2 * 20 * tiles


def test_hard_negatives_of_nothing(spark):
    shape = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    for rows in ([], [(1, [0.5], 1)], [(100, None, 1)], [(100, [0.5], 1)]):
        out = hard_negatives(negative_frame(spark, rows), F.col("vec_id") % 100 == 0)
        assert rows_of(out) == [] and tuple(out.columns) == shape
    with pytest.raises(ValueError):
        hard_negatives(negative_frame(spark, [(0, [1e300], 1)]), F.col("vec_id") % 100 == 0)


@pytest.mark.parametrize("n", [10_000, 1_000_000, 100_000_000])
def test_lattice_recall_holds_as_the_lattice_gets_finer(n):
    """Links at exactly the threshold meet in some table, at any size and dimension."""
    from starloom.llm import lattice
    scale, tables = lattice.fineness(n, 0.95)
    for dim in (32, 128):
        x, y = lattice.pairs_at(0.95, 500, dim, 7)
        assert abs((x * y).sum(1) - 0.95).max() < 1e-9
        assert lattice.met(x, y, tables, scale).any(1).mean() > 0.999
    assert n <= 22_000 or scale > lattice.SCALE
