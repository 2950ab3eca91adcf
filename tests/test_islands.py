"""Islands of ids and draws over gaps."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from starloom.operators.islands import key_islands, pick
from starloom.operators.store import materialize
from starloom.plans import generate
from starloom.sources.tables import Warehouse


def islands_by_hand(ids):
    out = []
    for n, i in enumerate(sorted(set(ids) - {None})):
        if out and out[-1][1] == i - 1:
            out[-1][1:3] = [i, out[-1][2] + 1]
        else:
            out.append([i, i, 1, n])
    return [tuple(x) for x in out]


@pytest.mark.parametrize("ranges", [None, 9])
def test_islands_by_brute_force(spark, ranges):
    rng = random.Random(3)
    ids = [*range(100, 400), *(rng.randrange(-50, 2000) for _ in range(300)), 5, 5, None]
    got = key_islands(spark.createDataFrame([(i,) for i in ids], "k long"), "k", ranges=ranges)
    assert sorted(map(tuple, got.collect())) == islands_by_hand(ids)
    assert key_islands(spark.createDataFrame([(None,)], "k long"), "k").collect() == []


@pytest.mark.parametrize("searched,ranges", [(1000, None), (0, None), (0, 6)])
def test_every_rank_finds_its_id_both_ways(spark, searched, ranges):
    ids = sorted({*range(10, 60), *range(100, 130, 3), 500, 502, 503})
    found = materialize(key_islands(spark.createDataFrame([(i,) for i in ids], "k long"), "k"))
    draws = spark.range(-2, len(ids) + 2).select(F.col("id").alias("r"), F.lit("x").alias("rank")).unionByName(spark.createDataFrame([(0, "again"), (None, "none")], "r long, rank string"))
    got = {(r["r"], r["rank"], r["id"]) for r in pick(draws, found, "r", "id", searched=searched, ranges=ranges).collect()}
    assert got == {(r, "x", ids[r] if 0 <= r < len(ids) else None) for r in range(-2, len(ids) + 2)} | {(0, "again", ids[0]), (None, "none", None)}


def test_generators_on_ids_with_holes_make_all_their_rows(spark):
    """Dense ids give what they gave; with holes no order or line is lost."""
    import datetime as dt

    class Gappy(Warehouse):
        def products(self):
            return super().products().where(F.col("productid") % 3 != 1)
    wh, days = Warehouse(spark, SMALL), (dt.date(1998, 1, 1), dt.date(1998, 1, 10))
    dense = spark.range(100_001, 100_101).withColumnRenamed("id", "new_customerid")
    holes = dense.where("new_customerid % 7 < 3")
    a, b = (generate.generate_orders(wh, *days, customers=c) for c in (dense, holes))
    assert a.count() == b.count() > 100
    assert {r[0] for r in b.select("customerid").distinct().collect()} <= {r[0] for r in holes.collect()}
    lines = generate.generate_order_details(Gappy(spark, SMALL), a.select("orderid"))
    whole = generate.generate_order_details(wh, a.select("orderid"))
    assert lines.count() == whole.count() and lines.where("productid % 3 = 1 OR unitprice IS NULL").count() == 0
    checked = generate.generate_order_details(wh, a.select("orderid"), check_missing=True)
    assert sorted(whole.collect()) == sorted(checked.collect())
