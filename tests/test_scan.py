"""Scans over a global order, and the type-2 operators built on them, against plain
Python, in one range and cut into many."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import scd2
from starloom.operators.scan import RANGE, scan, with_ranges
from test_plans import plan


def scanned_by_hand(rows):
    """rows (g, o, v) -> g, o, v, number, total, previous v, next v, last v."""
    key = lambda r: ((r[0] is not None, r[0] or 0), (r[1] is not None, r[1] or 0), )
    out, groups = [], {}
    for r in sorted(rows, key=key):
        groups.setdefault(r[0], []).append(r)
    for g, own in groups.items():
        total, last = None, None
        for i, (_, o, v) in enumerate(own):
            total = total if v is None else v + (total or 0)
            last = last if v is None else v
            out.append((g, o, v, i + 1, total, own[i - 1][2] if i else None, own[i + 1][2] if i + 1 < len(own) else None, last))
    return sorted(out, key=str)


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_scan_by_brute_force(spark, ranges):
    """A group with half the rows, groups of one row, null groups and null values."""
    rng = random.Random(ranges)
    rows = [(1, i, rng.choice((None, 1, 2, 5))) for i in range(600)] + [(100 + i, i, i) for i in range(200)]
    rows += [(rng.randrange(5, 20), 1000 + i, rng.choice((None, -3, 4))) for i in range(300)] + [(None, i, i % 3 or None) for i in range(50)]
    rows += [(2, None, 8)] + [(3, i, None) for i in range(90)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g long, o long, v long").repartition(5)
    got = scan(df, ["g"], ["o"], number="n", sums={"t": "v"}, previous={"p": "v"}, following={"f": "v"}, last={"l": "v"}, ranges=ranges)
    assert sorted(map(tuple, got.collect()), key=str) == scanned_by_hand(rows)


@pytest.mark.parametrize("ranges", [None, 9])
def test_scan_without_groups_and_of_nothing(spark, ranges):
    df = spark.range(500).select(((F.col("id") * 37) % 500).alias("o"), F.lit(2).alias("v")).repartition(3)
    got = sorted(map(tuple, scan(df, [], ["o"], number="n", sums={"t": "v"}, previous={"p": "o"}, following={"f": "o"}, ranges=ranges).collect()))
    assert got == [(i, 2, i + 1, 2 * i + 2, i - 1 if i else None, i + 1 if i < 499 else None) for i in range(500)]
    empty = scan(df.where("o < 0"), [], ["o"], number="n", previous={"p": "o"}, ranges=ranges)
    assert empty.collect() == [] and empty.columns == ["o", "v", "n", "p"]


def test_rows_that_tie_get_numbers_once(spark):
    df = spark.range(1000).select(F.lit(1).alias("g"), F.lit(1).alias("o"), "id")
    got = scan(df, ["g"], ["o"], number="n", ranges=8).collect()
    assert sorted(r["n"] for r in got) == list(range(1, 1001)) and len({r["id"] for r in got}) == 1000


def test_ranges_are_even_and_in_order(spark):
    from starloom.operators.store import materialize
    df = materialize(spark.range(20_000).select(F.when(F.col("id") < 12_000, 5).otherwise(F.col("id")).alias("g"), "id"))
    rows, n = with_ranges(df, ["g", "id"], 10)
    got = rows.groupBy(RANGE).agg(F.count("*").alias("n"), F.min(F.struct("g", "id")).alias("a"), F.max(F.struct("g", "id")).alias("z"))
    parts = got.orderBy(RANGE).collect()
    assert 8 <= len(parts) <= n <= 12 and max(r["n"] for r in parts) < 2 * 20_000 / 10
    assert all(tuple(x["z"]) < tuple(y["a"]) for x, y in zip(parts, parts[1:]))


def test_scan_keeps_rows_out_of_single_tasks(spark):
    """What goes to one partition are the ranges' states and the sample of the bounds."""
    df = spark.range(5_000).select(F.col("id").alias("o"))
    lines = plan(scan(df, [], ["o"], number="n", ranges=6), "simple").splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert any(RANGE in x and "partial_" in x or "_scan_cuts" in x or "collect_list" in x for x in lines[max(0, i - 4):i + 5]), lines[i:i + 4]


# ---- type 2

def d(n):
    return dt.date(2000, 1, 1) + dt.timedelta(days=n)


def history(dim, log):
    """Day by day: what each key holds, from stored versions and then the log."""
    span = range(-5, 130)
    out = {}
    for key in {r[1] for r in dim} | {r[0] for r in log if r[0] is not None}:
        changes = {}
        for k, day, op, seq, v in log:
            if k == key and day is not None:
                rank = (seq, op != "D", v is not None, v or "")
                if day not in changes or rank > changes[day][0]:
                    changes[day] = (rank, None if op == "D" else (v,))
        own = [r for r in dim if r[1] == key]
        now, days = None, []
        for n in span:
            for _, _, v, start, end in own:
                if end is not None and d(n) == end + dt.timedelta(days=1):
                    now = None
            for _, _, v, start, end in own:
                if d(n) == start:
                    now = (v,)
            if d(n) in changes:
                now = changes[d(n)][1]
            days.append(now)
        out[key] = days
    return out


def case(seed):
    rng = random.Random(seed)
    dim, sk = [], 0
    for key in range(12):
        day = rng.randrange(0, 20)
        for _ in range(rng.randrange(0, 5)):
            sk += 1
            end = day + rng.randrange(1, 20)
            last = rng.random() < 0.3
            dim.append((sk, key, rng.choice(("a", "b", None)), d(day), None if last else d(end)))
            if last:
                break
            day = end + 1 + rng.choice((0, 0, 5))
    log = []
    for i in range(60):
        log.append((rng.choice((*range(3, 14), 4, 4, 4, None)), rng.choice((d(rng.randrange(0, 90)),) * 9 + (None,)), rng.choice("UUUD"), rng.randrange(20),
                    rng.choice(("a", "b", "c", None))))
    return dim, log


@pytest.mark.parametrize("seed,ranges", [(1, None), (2, 6), (3, 15)])
def test_change_log_by_brute_force(spark, seed, ranges):
    dim, log = case(seed)
    dims = spark.createDataFrame([(*r[:4], r[4] or scd2.OPEN_END, "N" if r[4] else "Y") for r in dim],
                                 "sk long, k long, v string, effective_start_date date, effective_end_date date, current_flag string")
    logs = spark.createDataFrame([(*r, "clash") for r in log], "k long, change_date date, op string, change_seq long, v string, sk string")
    got = [tuple(r) for r in scd2.scd2_changes(dims, logs, ["k"], ["v"], "sk", ranges=ranges).collect()]
    hit = {k for k, day, *_ in log if None not in (k, day)}
    for key, days in history(dim, log).items():
        mine = sorted((r for r in got if r[1] == key), key=lambda r: r[3])
        held = [next(((v,) for _, _, v, a, z, _ in mine if a <= d(n) <= z), None) for n in range(-5, 130)]
        assert held == days, key
        if key in hit:  # neighbours differ
            assert all(x[4] + dt.timedelta(days=1) < y[3] or x[2] != y[2] for x, y in zip(mine, mine[1:]))
        else:
            assert [r[0] for r in mine] == [r[0] for r in dim if r[1] == key]
        assert all((r[4] == scd2.OPEN_END) == (r[5] == "Y") for r in mine)
    stored = {(r[1], r[3]): r[0] for r in dim}
    new = sorted((r[1], r[3], r[0]) for r in got if (r[1], r[3]) not in stored)
    assert all(r[0] == stored[r[1], r[3]] for r in got if (r[1], r[3]) in stored)
    assert [r[2] for r in new] == list(range(len(dim) + 1, len(dim) + 1 + len(new)))


def test_change_log_without_changes_or_without_versions(spark):
    shape = "sk long, k long, v string, effective_start_date date, effective_end_date date, current_flag string"
    log = "k long, change_date date, op string, change_seq long, v string"
    dims = spark.createDataFrame([(5, 1, "a", d(0), scd2.OPEN_END, "Y")], shape)
    assert [tuple(r) for r in scd2.scd2_changes(dims, spark.createDataFrame([], log), ["k"], ["v"]).collect()] == [tuple(r) for r in dims.collect()]
    got = scd2.scd2_changes(spark.createDataFrame([], shape), spark.createDataFrame([(1, d(3), "U", 1, "x"), (2, d(1), "D", 1, None)], log), ["k"], ["v"])
    assert [tuple(r) for r in got.collect()] == [(1, 1, "x", d(3), scd2.OPEN_END, "Y")]


@pytest.mark.parametrize("ranges", [1, 5])
def test_lookup_both_ways_agree(spark, ranges):
    rng = random.Random(9)
    dim = []
    for key in range(20):
        day = 0
        for v in range(rng.randrange(0, 9)):
            end = day + rng.randrange(0, 9)
            dim.append((key, v, d(day), d(end)))
            day = end + 1 + rng.choice((0, 0, 3))
    facts = [(rng.choice((*range(25), None)), rng.choice((d(rng.randrange(-3, 60)), None)), i) for i in range(800)] + [(3, d(5), 1)] * 3
    dims = spark.createDataFrame(dim, "k long, version int, effective_start_date date, effective_end_date date")
    rows = spark.createDataFrame(facts, "k long, day date, i int")
    cols = ["k", "day", "i", "version"]
    a = scd2.scd2_lookup(rows, dims, "k", "day").select(cols)
    b = scd2.scd2_merge_lookup(rows, dims, "k", "day", ranges=ranges).select(cols)
    assert sorted(a.collect()) == sorted(b.collect()) and a.count() > 50


def test_a_hot_key_makes_no_pairs(spark):
    """One key with 10,000 versions and half of 40,000 facts: the merge handles rows, not
    2 * 10**8 pairs, and spreads the key over ranges."""
    versions = spark.range(10_000).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("version"),
                                          F.expr("date_add(DATE '1990-01-01', CAST(id AS INT))").alias("effective_start_date"),
                                          F.expr("date_add(DATE '1990-01-01', CAST(id AS INT))").alias("effective_end_date"))
    facts = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.col("id").alias("i"),
                                       F.expr("date_add(DATE '1990-01-01', CAST(id % 10000 AS INT))").alias("day"))
    out = scd2.scd2_merge_lookup(facts, versions, "k", "day", ranges=8)
    got = out.agg(F.count("*"), F.sum((F.col("version") == F.col("i") % 10_000).cast("int"))).first()
    assert tuple(got) == (20_000, 20_000)
    text = plan(out, "simple")
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "direct_shuffle_partition_id(" + RANGE in text  # by key alone go only the ranges' states, after their partial sums
    lines = text.splitlines()
    assert all("Aggregate(key=[" + RANGE in lines[i + 1] for i, line in enumerate(lines) if "hashpartitioning(_key" in line)


def test_the_search_for_ranges_is_compiled(spark, tmp_path):
    """A column for each step; a lambda over the steps would be interpreted for every row."""
    spark.range(1000).withColumn("g", F.col("id") % 3).write.parquet(str(tmp_path / "r"))
    rows, n = with_ranges(spark.read.parquet(str(tmp_path / "r")), ["g", "id"], 10)
    text = rows._jdf.queryExecution().toString()
    assert n > 4 and "lambda" not in text
    assert [r[RANGE] for r in rows.orderBy("g", "id").collect()] == sorted(r[RANGE] for r in rows.collect())
