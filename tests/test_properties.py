"""Properties: dense keys for any partitioning, idempotent dedup, repeatable
generators, pivot totals, type-2 idempotence."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SMALL
from starloom.operators.dedup import PAIR, first_per_pair
from starloom.operators.keys import surrogate_key
from starloom.operators import scd2
from starloom.plans import generate, retail
from starloom.sources.tables import LINE_ORDER, Warehouse


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_surrogate_key_dense_and_ordered(spark, parts):
    lines = Warehouse(spark, SMALL).order_lines().select(*LINE_ORDER)
    keyed = surrogate_key(lines, LINE_ORDER, "k", 7, num_partitions=parts)
    n = lines.count()
    stats = keyed.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
    assert tuple(stats) == (7, 6 + n, n)
    ref = lines.withColumn("r", F.row_number().over(Window.orderBy(*LINE_ORDER)) + 6)
    assert keyed.join(ref, LINE_ORDER).filter(F.col("k") != F.col("r")).count() == 0


def test_dedup_unique_and_idempotent(spark):
    lines = Warehouse(spark, SMALL).order_lines()
    keep = ["orderid", "productid", "suppkey", "linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    once = first_per_pair(lines, LINE_ORDER, keep)
    assert once.groupBy(*PAIR).count().filter("count > 1").count() == 0
    assert once.count() == lines.select(*PAIR).distinct().count()
    twice = first_per_pair(once, LINE_ORDER, keep)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_generators_do_not_depend_on_partitioning(spark):
    wh = Warehouse(spark, SMALL)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        a = generate.generate_order_details(Warehouse(spark, SMALL)).collect()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        b = generate.generate_order_details(Warehouse(spark, SMALL)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert sorted(a) == sorted(b)
    orders = generate.generate_orders(wh)
    per_day = orders.groupBy("orderdate").count().agg(F.min("count"), F.max("count")).first()
    assert 10 <= per_day[0] and per_day[1] <= 50
    ids = orders.agg(F.min("orderid"), F.max("orderid"), F.count(F.lit(1))).first()
    assert ids[0] == 100001 and ids[1] == 100000 + ids[2]


def test_replication_counts(spark):
    wh = Warehouse(spark, SMALL)
    n = wh.customers().count()
    rep = generate.replicate_customers(wh, 6)
    assert rep.count() == 64 * n
    assert rep.agg(F.countDistinct("new_customerid")).first()[0] == 64 * n


def test_pivot_totals_equal_unpivoted(spark):
    wh = Warehouse(spark, SMALL)
    flat = retail.orders_by_country_quarter(wh, 1998).agg(F.sum("no_of_orders")).first()[0]
    piv = retail.orders_quarter_pivot(wh, 1998)
    tot = piv.select(sum(F.coalesce(F.col(q), F.lit(0)) for q in ["q1", "q2", "q3", "q4"]).alias("t"))
    assert tot.agg(F.sum("t")).first()[0] == flat


def test_scd2_apply_twice_is_stable(spark):
    dim0 = scd2.initial_versions(
        spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), ["id"], dt.date(2000, 1, 1))
    snap = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "id long, v string")
    once = scd2.scd2_apply(dim0, snap, ["id"], ["v"], dt.date(2001, 1, 1))
    rows = {(r.id, r.v): (r.sk, r.effective_end_date, r.current_flag) for r in once.collect()}
    assert rows[(1, "a")] == (1, scd2.OPEN_END, "Y")
    assert rows[(2, "b")] == (2, dt.date(2000, 12, 31), "N")
    assert rows[(2, "B")][1:] == (scd2.OPEN_END, "Y") and rows[(3, "c")][2] == "Y"
    assert sorted(v[0] for v in rows.values()) == [1, 2, 3, 4]
    twice = scd2.scd2_apply(once, snap, ["id"], ["v"], dt.date(2002, 1, 1))
    assert sorted(once.collect()) == sorted(twice.collect())


def test_scd2_lookup_boundaries(spark):
    dim = spark.createDataFrame(
        [(1, 1, dt.date(1900, 1, 1), dt.date(1997, 12, 31)), (1, 2, dt.date(1998, 1, 1), dt.date(9999, 12, 31))],
        "course_id long, version int, effective_start_date date, effective_end_date date")
    facts = spark.createDataFrame([(1, dt.date(1997, 12, 31)), (1, dt.date(1998, 1, 1))],
                                  "course_id long, day date")
    got = {r.day: r.version for r in scd2.scd2_lookup(facts, dim, "course_id", "day").collect()}
    assert got == {dt.date(1997, 12, 31): 1, dt.date(1998, 1, 1): 2}


def test_reference_day_span_of_the_order_generator(spark):
    wh = Warehouse(spark, SMALL)
    cust = spark.range(100002, 105826).withColumnRenamed("id", "new_customerid")
    o = generate.generate_orders(wh, dt.date(2016, 6, 30), dt.date(2025, 7, 1), customers=cust)
    days = o.groupBy("orderdate").count()
    stats = days.agg(F.count(F.lit(1)), F.min("count"), F.max("count")).first()
    assert stats[0] == 3289 and stats[1] >= 10 and stats[2] <= 50
    ranges = o.agg(F.min("customerid"), F.max("customerid"), F.min("employeeid"), F.max("employeeid"),
                   F.min("shipvia"), F.max("shipvia"), F.min("freight"), F.max("freight")).first()
    assert 100002 <= ranges[0] and ranges[1] <= 105825
    assert (ranges[2], ranges[3]) == (1, 9) and (ranges[4], ranges[5]) == (1, 6)
    assert float(ranges[6]) >= 5.99 and float(ranges[7]) <= 99.99


def test_dedup_counts_at_sf001(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    s = q["duplicate_summary"](spark, "/root/testdata/sf0.01").first()
    assert (s.total_rows, s.duplicate_rows) == (60000, 55)
    assert q["dedup_order_details"](spark, "/root/testdata/sf0.01").count() == 60000 - 55
    assert q["delete_duplicates"](spark, "/root/testdata/sf0.01").count() == 60000 - 55


def test_missing_product_raises(spark):
    wh = Warehouse(spark, SMALL)
    orders = spark.range(100001, 100201).withColumnRenamed("id", "orderid")
    # products with a gap in the id range: the draw must fail loudly
    class Gappy(Warehouse):
        def products(self):
            return super().products().filter(F.col("productid") % 2 == 0)
    with pytest.raises(Exception, match="has no product"):
        generate.generate_order_details(Gappy(spark, SMALL), orders, check_missing=True)
    assert generate.generate_order_details(wh, orders, check_missing=True).count() > 0


def test_hash_reaches_ids_past_32_bits(spark):
    from starloom.functions.scalar import hash_random
    top = spark.range(2000).select(F.max(hash_random("x", 0, 2 ** 50, "id"))).first()[0]
    assert top > 2 ** 49


def test_generated_rows_come_from_many_partitions(spark):
    orders = generate.generate_orders(Warehouse(spark, SMALL), dt.date(1998, 1, 1), dt.date(1998, 1, 20), per_day=(10, 5000))
    per = [r["n"] for r in orders.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(per) > 1 and max(per) < 0.6 * sum(per)
    ids = orders.agg(F.count(F.lit(1)), F.countDistinct("orderid"), F.min("orderid"), F.max("orderid")).first()
    assert ids[0] == ids[1] == ids[3] - ids[2] + 1


def test_round_ratio_is_exact(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal
    from starloom.functions.scalar import round_ratio
    rng = random.Random(4)
    rows = [(1034808624104449, 8318397299875), (5 * 10 ** 16, 10 ** 16), (-7, 2), (1, 0)]
    for _ in range(5000):
        d = rng.randrange(1, 10 ** 13)
        rows.append((d * rng.randrange(1, 20_000) // 200 + rng.choice((-1, 0, 1)), d))
    df = spark.createDataFrame(rows, "a long, b long")
    for a, b, got in df.select("a", "b", round_ratio("a", "b")).collect():
        want = None if b == 0 else float((Decimal(a) / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert got == want, (a, b)
