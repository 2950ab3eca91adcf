"""Loads that meet what is stored: key maps, the gate, rewrites of single partitions."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from starloom.operators import gate
from starloom.operators.keys import KeyMap
from test_plans import plan


@pytest.fixture
def key_map(spark, tmp_path):
    made = []

    def make(keys=("k",), **how):
        m = KeyMap(spark, f"keys_{uuid.uuid4().hex}", list(keys), path=str(tmp_path / uuid.uuid4().hex), **how)
        made.append(m)
        return m
    yield make
    for m in made:
        spark.sql(f"DROP TABLE IF EXISTS {m.name}")


def test_key_map_over_loads(spark, key_map):
    """Old keys stay, new ones are dense above the highest, in key order."""
    m = key_map(start=10, buckets=3)
    first = spark.createDataFrame([(5, "x"), (2, "y"), (2, "z"), (None, "n")], "k long, other string")
    assert m.load(first) == 2 and sorted(map(tuple, m.read().collect())) == [(2, 10), (5, 11)]
    second = spark.createDataFrame([(9,), (1,), (5,), (None,), (9,)], "k long")
    assert m.load(second) == 2 and sorted(map(tuple, m.read().collect())) == [(1, 12), (2, 10), (5, 11), (9, 13)]
    assert m.load(second) == 0 and m.read().count() == 4
    got = m.attach(second.unionByName(spark.createDataFrame([(77,)], "k long"))).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(9, 13), (1, 12), (5, 11), (None, None), (9, 13), (77, None)], key=str)


def test_key_map_of_nothing_and_of_two_columns(spark, key_map):
    m = key_map(("a", "b"))
    assert m.read() is None and m.load(spark.createDataFrame([], "a long, b string")) == 0 and m.read().count() == 0
    assert m.load(spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (None, "a")], "a long, b string")) == 2
    assert sorted(map(tuple, m.read().collect())) == [(1, "a", 1), (1, "b", 2)]


def test_later_loads_read_the_map_in_its_buckets(spark, key_map):
    m = key_map(buckets=4)
    m.load(spark.range(1000).withColumnRenamed("id", "k"))
    wanted = spark.range(500, 1500).select(F.col("id").alias("k")).distinct()
    text = plan(wanted.join(m.read().hint("merge"), ["k"], "left_anti"), "simple")
    assert "Bucketed: true" in text and text.count("hashpartitioning") == 1 and "BroadcastHashJoin" not in text
    assert m._buckets(10**9) == 4  # as stored


def test_gate_by_brute_force(spark):
    rng = random.Random(2)
    rows = [(rng.choice((1, 1, 1, 2, 3, 4, 5, None)), rng.choice(("a", "bb", "ccc", None)), rng.choice((0, 5, 9, None)), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k long, name string, n int, i int").repartition(6)
    target = spark.createDataFrame([(2, 0), (2, 1), (8, 2), (None, 3)], "k long, x int")
    names = spark.createDataFrame([("a",), ("bb",), ("bb",), (None,)], "label string")
    out = gate.marked(df, checks={"small": F.col("n") < 9}, required=["n"], lengths={"name": 2}, key=["k"], target=target, first_by=["i"],
                      parents={"names": (names, ["name"], ["label"])})
    assert out.columns == [*df.columns, gate.BROKEN]
    first = {}
    for k, _, _, i in rows:
        first[k] = min(first.get(k, i), i)
    want = []
    for k, name, n, i in rows:
        bad = [r for r, hit in (("key:exists", k == 2), ("key:null", k is None), ("key:repeated", k is not None and i != first[k]),
                                ("length:name", name is not None and len(name) > 2), ("null:n", n is None),
                                ("parent:names", name is not None and name not in ("a", "bb")), ("small", n is not None and n >= 9)) if hit]
        want.append((k, name, n, i, bad))
    assert sorted(map(tuple, out.collect()), key=lambda r: r[3]) == sorted(want, key=lambda r: r[3])


def test_gate_of_rows_that_repeat_and_of_nothing(spark):
    df = spark.createDataFrame([(1,)] * 5, "k long")
    assert sorted(len(r[gate.BROKEN]) for r in gate.marked(df, key=["k"]).collect()) == [0, 1, 1, 1, 1]
    assert gate.marked(df.where("k = 2"), key=["k"], target=df).collect() == []
    assert [r[gate.BROKEN] for r in gate.marked(df, checks={"x": F.col("k") > 5}).collect()] == [["x"]] * 5


def test_load_through_the_gate(spark, tmp_path):
    """accepted + rejected = given; the table itself is the key's target in later loads."""
    table, rejects = str(tmp_path / "t"), str(tmp_path / "r")
    rules = {"key": ["k"], "required": ["v"], "first_by": ["v"]}
    one = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, None)], "k long, v string")
    assert gate.load(one, table, rejects, **rules) == (2, 2)
    two = spark.createDataFrame([(2, "z"), (3, "d"), (None, "e")], "k long, v string")
    assert gate.load(two, table, rejects, **rules) == (1, 2)
    assert sorted(map(tuple, spark.read.parquet(table).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    got = sorted(((r["k"], r["v"], tuple(r[gate.BROKEN])) for r in spark.read.parquet(rejects).collect()), key=str)
    assert got == sorted([(2, "c", ("key:repeated",)), (3, None, ("null:v",)), (2, "z", ("key:exists",)), (None, "e", ("key:null",))], key=str)


# ---- partitions

def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("part-*")}


@pytest.fixture
def orders_table(spark, tmp_path):
    from starloom.sources.io import write_table
    path = tmp_path / "orders"
    rows = [(i, i % 5, f"1998-{1 + i % 12:02d}") for i in range(240)] + [(900, 1, None), (901, 2, "a b/c=%")]
    write_table(spark.createDataFrame(rows, "id long, v int, month string").repartition(1), str(path), ["month"])
    return path, {r[0]: r[1:] for r in rows}


def stored_rows(spark, path):
    return {r["id"]: (r["v"], r["month"]) for r in spark.read.parquet(str(path)).collect()}


def test_a_month_is_merged_and_others_keep_their_files(spark, orders_table):
    """Changed, new and moved rows; a key of another month takes that month along."""
    from starloom.sources.partitions import merge_rows
    path, want = orders_table
    before = files(path)
    changes = [(2, 77, "1998-03"), (1000, 5, "1998-03"), (14, 9, "1998-03"), (3, 1, "1998-03")]  # 3 was in April
    n = merge_rows(spark, str(path), spark.createDataFrame(changes, "id long, v int, month string"), ["id"], ["month"])
    assert n == 2 and stored_rows(spark, path) == want | {c[0]: c[1:] for c in changes}
    kept = {f for f in before if not f.startswith(("month=1998-03", "month=1998-04"))}
    assert len(kept) == 12 and kept <= files(path) and not (before - kept) & files(path)
    with pytest.raises(ValueError):
        merge_rows(spark, str(path), spark.createDataFrame([(1, 1, "x"), (1, 2, "x")], "id long, v int, month string"), ["id"], ["month"])


def test_update_and_delete_touch_their_partitions(spark, orders_table):
    from starloom.sources.partitions import delete_rows, update_rows
    path, want = orders_table
    before = files(path)
    assert update_rows(spark, str(path), F.col("month") == "1998-05", {"v": F.col("v") + 100}, ["month"]) == 1
    want = {k: (v + 100, m) if m == "1998-05" else (v, m) for k, (v, m) in want.items()}
    assert stored_rows(spark, path) == want
    assert {f for f in before if not f.startswith("month=1998-05")} <= files(path)
    # a row that moves, from a partition with a strange name and from the null one
    assert update_rows(spark, str(path), F.col("id").isin(901, 900), {"month": F.lit("1998-07")}, ["month"]) == 3
    want |= {901: (2, "1998-07"), 900: (1, "1998-07")}
    assert stored_rows(spark, path) == want
    before = files(path)
    assert delete_rows(spark, str(path), (F.col("month") == "1998-09") | (F.col("id") == 0), ["month"]) == 2
    want = {k: x for k, x in want.items() if x[1] != "1998-09" and k != 0}
    assert stored_rows(spark, path) == want
    assert {f for f in before if not f.startswith(("month=1998-09", "month=1998-01"))} <= files(path)
    assert not any(f.startswith("month=1998-09") for f in files(path))
    before = files(path)
    assert delete_rows(spark, str(path), F.col("id") < 0, ["month"]) == 0 and update_rows(spark, str(path), F.lit(None).cast("boolean"), {}, ["month"]) == 0
    assert files(path) == before


# ---- order-keyed layout

@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    from conftest import SMALL
    from starloom.sources.layout import ORDER_KEYED, write_order_buckets
    from starloom.sources.tables import Warehouse
    prefix = f"small_{uuid.uuid4().hex}"
    yield write_order_buckets(Warehouse(spark, SMALL), prefix, str(tmp_path_factory.mktemp("buckets")))
    for name in ORDER_KEYED:
        spark.sql(f"DROP TABLE IF EXISTS {prefix}_{name}")


LAYOUT_KEYS = ["overdue_month", "overdue_member_behaviour", "repeat_offenders", "membership_utilisation_month", "staff_workload", "staff_report", "overdue_by_region",
               "overdue_by_category", "staff_member_interactions", "duration_vs_overdue", "avg_utilisation", "overdue_by_holiday", "enrollment_fact", "star_sales"]


@pytest.mark.parametrize("key", LAYOUT_KEYS)
def test_reports_are_the_same_on_the_order_layout(spark, duck, bucketed, key):
    from compare import assert_same
    from starloom.registry import ORACLE, PLANS
    assert_same(PLANS[key](bucketed), duck, ORACLE[key])


def test_the_loan_join_needs_no_shuffle(spark, bucketed):
    size = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loans = plan(bucketed.loan_keys(), "simple")
        assert "SortMergeJoin" in loans and "Exchange" not in loans and loans.count("Bucketed: true") == 2
        text = plan(bucketed.book_loans(), "simple")
        lines = text.splitlines()
        low = max(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "l_orderkey" in line)
        scans = [line for line in lines if "Bucketed: true" in line]
        assert len(scans) == 2 and not any("Exchange" in line for line in lines[low:max(i for i, x in enumerate(lines) if "Bucketed: true" in x)])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)


def test_a_gate_without_broken_keys_moves_no_rows(spark):
    df = spark.range(200).select(F.col("id").alias("k"), (F.col("id") % 9).alias("p"), F.lit("wide").alias("w"))
    out = gate.marked(df, key=["k"], first_by=["w"], parents={"p": (spark.range(9), ["p"], ["id"])})
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r[gate.BROKEN]) for r in out.collect()} == {()}
