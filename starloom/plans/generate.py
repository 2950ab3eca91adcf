"""Synthetic data generators: customer replication, orders, order lines.

Every random draw is ``hash_random(salt, lo, hi, keys...)``: a function of
the row's own keys, so the output does not depend on partitioning, task
order or retries, and DuckDB reproduces it from the same md5 rule.

* customers: each row expanded into 2**n copies with ``explode(sequence)``
  (a narrow per-row expansion, no join), new ids numbered from 100001;
* orders: one row per calendar day with its order count drawn in [lo, hi];
  ids follow (day, i) and come from a prefix sum over the days (a table
  bounded by the length of the date range), so the orders are never
  globally sorted;
* lines: each order expanded into 1..5 lines; product, quantity and
  discount drawn per (order, line); unit price looked up by a key join;
  the running record number is a dense surrogate key over (order, line).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.scalar import hash_int, hash_random, scalar_row
from starloom.operators.islands import islands_and_count, pick
from starloom.operators.keys import surrogate_key
from starloom.sources.tables import Warehouse

# First new id, and the length a company name is cut to
# before '-' and the new id are appended
NEW_ID_START = 100001
NAME_CUT = 18
# orders of a day that are made together
DAY_PART = 500


def replicate_customers(wh: Warehouse, doublings: int = 6) -> DataFrame:
    """Customers copied 2**doublings times (91 -> 5,824 for 6 doublings) and
    re-keyed: id = 100001.., name = first 18 characters + '-' + id."""
    copies = 2 ** doublings
    ranked = surrogate_key(wh.customers(), ["customerid"], "_k", 0)
    rep = ranked.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    new_id = (F.lit(NEW_ID_START) + F.col("_k") * copies + F.col("copy")).cast("bigint")
    return rep.select(
        new_id.alias("new_customerid"),
        F.concat_ws("", F.substring("companyname", 1, NAME_CUT), F.lit("-"), new_id.cast("string"))
         .alias("companyname"),
        "city", "region", "postalcode", "country")


def generate_orders(wh: Warehouse, start: dt.date | None = None, end: dt.date | None = None,
                    per_day=(10, 50), customers: DataFrame | None = None,
                    doublings: int = 6) -> DataFrame:
    """Orders for every day from ``start`` to ``end`` (default: the span of
    the supplied orders): per_day[0]..per_day[1] orders a day, customer drawn
    from the replicated id range, employee 1-9, shipper 1-6, required +7 d,
    shipped +3 d, freight 5.99..99.99."""
    spark = wh.spark
    ids = None
    if start is None or end is None:
        o = wh.orders().select("orderdate")
        bounds = o.agg(F.min("orderdate").alias("s"), F.max("orderdate").alias("e"))
    else:
        bounds = spark.range(1).select(F.lit(start).alias("s"), F.lit(end).alias("e"))
    if customers is None:
        # the replicated ids are NEW_ID_START .. NEW_ID_START + copies * n - 1:
        # the range follows from the customer count without expanding copies
        lo = F.lit(NEW_ID_START).cast("bigint")
        span = wh.customers().agg(F.count(F.lit(1)) * (2 ** doublings)).scalar()
    else:
        ids, span = islands_and_count(customers, "new_customerid")
        lo = F.lit(0).cast("bigint")
    days = bounds.select(F.explode(F.sequence("s", "e")).alias("orderdate"))
    days = days.withColumn("n", hash_random("orders_per_day", per_day[0], per_day[1] + 1, "orderdate"))
    # one row per day of the range: a running sum over it is small by construction
    before = F.coalesce(F.sum("n").over(
        Window.orderBy("orderdate").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    days = days.withColumn("before", before)
    # the day table sits in one task: deal it out in parts of a day before rows are made of it
    n = F.col("n").cast("int")
    parts = days.select("orderdate", "before", n.alias("n"), F.explode(
        F.sequence(F.lit(0), F.floor((n - 1) / DAY_PART).cast("int"))).alias("part")).where("n > 0")
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "orderdate", "part")
    gen = parts.select("orderdate", "before", F.explode(F.sequence(
        F.col("part") * DAY_PART + 1, F.least("n", (F.col("part") + 1) * DAY_PART))).alias("i"))
    d, i = F.col("orderdate"), F.col("i")
    out = gen.select(
        (F.lit(NEW_ID_START) + F.col("before") + i - 1).cast("bigint").alias("orderid"),
        (lo + F.pmod(hash_int("customer", d, i), span)).cast("bigint").alias("customerid"),
        hash_random("employee", 1, 10, d, i).alias("employeeid"),
        d.alias("orderdate"),
        F.date_add(d, 7).alias("requireddate"),
        F.date_add(d, 3).alias("shippeddate"),
        hash_random("shipper", 1, 7, d, i).alias("shipvia"),
        (hash_random("freight", 599, 10000, d, i) / F.lit(100)).cast("decimal(6,2)").alias("freight"))
    # of given customers the draw is a rank among their ids, which may have gaps
    return out if ids is None else pick(out.withColumnRenamed("customerid", "_rank"), ids, "_rank", "customerid").select(out.columns)


def generate_order_details(wh: Warehouse, orders: DataFrame | None = None,
                           lines_per_order=(1, 5), quantity=(1, 10),
                           discount_cents=(5, 70), check_missing: bool = False) -> DataFrame:
    """Lines for every order: product drawn from the product id range,
    quantity 1-10, discount 0.05-0.70, unit price from the product.

    Products are drawn by rank among their ids, so each draw hits one, gaps or
    not. The source draws from the id range, and its per-row lookup fails on an id
    without a product; ``check_missing=True`` keeps that contract: a left join whose missing
    price raises an error, in the same pass, instead of silently dropping the line."""
    o = generate_orders(wh) if orders is None else orders
    p = wh.products().select("productid", "unitprice")
    if check_missing:
        st = scalar_row(p, lo=F.min("productid"), span=F.max("productid") - F.min("productid") + 1)
        lo, span = st["lo"], st["span"]
    else:
        ids, span = islands_and_count(p, "productid")
        lo = F.lit(0).cast("bigint")
    per = o.select("orderid").withColumn(
        "n", hash_random("lines_per_order", lines_per_order[0], lines_per_order[1] + 1, "orderid"))
    lines = per.select("orderid", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("ctr"))
    k, c = F.col("orderid"), F.col("ctr")
    drawn = lines.select(
        "orderid", "ctr",
        (lo + F.pmod(hash_int("product", k, c), span)).cast("bigint").alias("productid"),
        hash_random("quantity", quantity[0], quantity[1] + 1, k, c).alias("quantity"),
        (hash_random("discount", discount_cents[0], discount_cents[1] + 1, k, c) / F.lit(100))
        .cast("decimal(3,2)").alias("discount"))
    if check_missing:
        priced = drawn.join(p.withColumn("found", F.lit(True)), "productid", "left").withColumn(
            "unitprice", F.when(F.col("found"), F.col("unitprice")).otherwise(
                F.raise_error(F.lit("a drawn product id has no product (gap in the product id range)")))).drop("found")
    else:
        priced = pick(drawn.withColumnRenamed("productid", "_rank"), ids, "_rank", "productid").drop("_rank").join(p, "productid")
    keyed = surrogate_key(priced, ["orderid", "ctr"], "rec_no", 1)
    return keyed.select("rec_no", "orderid", "productid", "unitprice", "quantity", "discount")
