"""Retail business questions over customers, orders and order lines.

Money is summed as exact decimals and reported as DOUBLE rounded to cents.
Where a question only needs a per-key total, lines are pre-aggregated to
that key before any join (the partial aggregate runs map-side), so the big
shuffles carry one row per key instead of one row per line. Year filters
are written as date ranges on the raw order timestamp so they reach the
parquet scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.scalar import hash_int, round_ratio, scalar_row, to_double_money
from starloom.operators.islands import islands_and_count, pick
from starloom.operators.keys import materialize
from starloom.plans.calendar import date_dim
from starloom.sources.tables import Warehouse


def _year_range(y0: int, y1: int | None = None):
    return dt.date(y0, 1, 1), dt.date(y1 if y1 is not None else y0, 12, 31)


def _line_value(wh: Warehouse) -> DataFrame:
    """(orderid, value) with value = gross * (1 - discount), unrounded."""
    return wh.order_details().select(
        "orderid", (F.col("gross") * (F.lit(1) - F.col("discount"))).alias("value"))


def customers_over_threshold(wh: Warehouse, year: int = 1995, threshold: float = 1000) -> DataFrame:
    """Customers whose net purchases in ``year`` exceed ``threshold``."""
    o = wh.orders(*_year_range(year)).select("orderid", "customerid")
    # the year's orders first, so that only their lines are summed
    per_cust = (_line_value(wh).join(o, "orderid").groupBy("customerid")
                .agg(F.sum("value").alias("total_purchase")))
    c = wh.customers().select("customerid", "companyname")
    return (per_cust.join(c, "customerid")
            .filter(F.col("total_purchase") > F.lit(threshold))
            .select("customerid", "companyname",
                    to_double_money("total_purchase").alias("total_purchase"))
            .orderBy(F.desc("total_purchase"), F.asc("customerid")))


def customers_over_threshold_by_year(wh: Warehouse, threshold: float = 1000) -> DataFrame:
    o = wh.orders().select("orderid", "customerid", F.year("orderdate").alias("order_year"))
    per_order = _line_value(wh).groupBy("orderid").agg(F.sum("value").alias("v"))
    per_cust = (per_order.join(o, "orderid").groupBy("customerid", "order_year")
                .agg(F.sum("v").alias("total_purchase")))
    c = wh.customers().select("customerid", "companyname")
    return (per_cust.join(c, "customerid")
            .filter(F.col("total_purchase") > F.lit(threshold))
            .select("customerid", "companyname", F.col("order_year").cast("bigint"),
                    to_double_money("total_purchase").alias("total_purchase")))


def category_order_counts(wh: Warehouse) -> DataFrame:
    """COUNT(orderid) of lines per category; lines of unknown orders or
    products drop out as in the inner-join chain."""
    lines = wh.order_details().select("orderid", "productid")
    known = lines.join(wh.orders().select("orderid"), "orderid", "left_semi")
    per_product = known.groupBy("productid").agg(F.count(F.lit(1)).alias("n"))
    p = wh.products().select("productid", "categoryname")
    return (per_product.join(p, "productid").groupBy("categoryname")
            .agg(F.sum("n").cast("bigint").alias("total_order")))


def best_categories(wh: Warehouse, k: int = 1) -> DataFrame:
    """Top-k categories by line count; ties broken by name."""
    return category_order_counts(wh).orderBy(F.desc("total_order"), F.asc("categoryname")).limit(k)


def top_shipper(wh: Warehouse) -> DataFrame:
    per_ship = wh.orders().groupBy("shipvia").agg(F.count(F.lit(1)).alias("n"))
    s = wh.shippers()
    return (per_ship.join(s, per_ship.shipvia == s.shipperid).groupBy("companyname")
            .agg(F.sum("n").cast("bigint").alias("total_orders"))
            .orderBy(F.desc("total_orders"), F.asc("companyname")).limit(1))


def lapsed_customers(wh: Warehouse, year: int = 1995) -> DataFrame:
    """Customers without an order in ``year`` (but with some order), and
    their latest order date. One grouped pass over orders replaces the
    MINUS + IN + join of the source."""
    start, end = _year_range(year)
    o = wh.orders().select("customerid", "orderdate")
    per = o.groupBy("customerid").agg(
        F.max("orderdate").alias("latest_purchase"),
        F.max(F.col("orderdate").between(F.lit(start), F.lit(end)).cast("int")).alias("_in_year"))
    c = wh.customers().select("customerid")
    return (per.filter(F.col("_in_year") == 0).join(c, "customerid", "left_semi")
            .select("customerid", "latest_purchase"))


def _orders_country(wh: Warehouse, year: int, days: tuple | None = None) -> DataFrame:
    o = wh.orders(*(days or _year_range(year))).select("customerid", "orderdate")
    c = wh.customers().select("customerid", "country")
    return o.join(c, "customerid").withColumn(
        "cal_quarter", F.concat(F.lit("Q"), F.quarter("orderdate").cast("string")))


def orders_by_country_quarter(wh: Warehouse, year: int = 1998, ordered: bool = True) -> DataFrame:
    out = (_orders_country(wh, year).groupBy("country", "cal_quarter")
           .agg(F.count(F.lit(1)).cast("bigint").alias("no_of_orders")))
    return out.orderBy(F.desc("no_of_orders"), "country", "cal_quarter") if ordered else out


def orders_quarter_pivot(wh: Warehouse, year: int = 1998) -> DataFrame:
    """One row per country, columns q1..q4; a missing quarter is NULL."""
    agg = orders_by_country_quarter(wh, year, ordered=False)
    p = agg.groupBy("country").pivot("cal_quarter", ["Q1", "Q2", "Q3", "Q4"]).agg(
        F.sum("no_of_orders"))
    return p.select("country", *[F.col(q).cast("bigint").alias(q.lower())
                                 for q in ["Q1", "Q2", "Q3", "Q4"]])


def orders_q1_by_country(wh: Warehouse, year: int = 1998) -> DataFrame:
    first = (dt.date(year, 1, 1), dt.date(year, 3, 31))
    return (_orders_country(wh, year, first).groupBy("country").agg(F.count(F.lit(1)).cast("bigint").alias("no_of_orders")))


def revenue_month_pivot(wh: Warehouse, years=(1996, 1998), months=(1, 6)) -> DataFrame:
    """Gross revenue (no discount) per year, months as columns m1..m6."""
    o = (wh.orders(*_year_range(*years)).select("orderid", "customerid", "orderdate")
         .filter(F.month("orderdate").between(*months)))
    o = o.join(wh.customers().select("customerid"), "customerid", "left_semi")
    j = wh.order_details().select("orderid", F.col("gross").alias("g")).join(o, "orderid").select(
        F.year("orderdate").alias("year_no"), F.month("orderdate").alias("month_no"), "g")
    month_list = list(range(months[0], months[1] + 1))
    p = j.groupBy("year_no").pivot("month_no", month_list).agg(F.sum("g"))
    return p.select(F.col("year_no").cast("bigint"),
                    *[to_double_money(F.col(str(m))).alias(f"m{m}") for m in month_list])


def dates_of_year(wh: Warehouse, year: int = 1998) -> DataFrame:
    return date_dim(wh).filter(F.col("cal_year") == year)


def missing_region(wh: Warehouse) -> DataFrame:
    return wh.customers().filter(F.col("region").isNull()).select("customerid")


def _revenue_per_customer(wh: Warehouse, o: DataFrame) -> DataFrame:
    per_order = wh.order_details().groupBy("orderid").agg(F.sum("net").alias("v"))
    return per_order.join(o, "orderid").groupBy("customerid").agg(F.sum("v").alias("v"))


def revenue_by_country(wh: Warehouse) -> DataFrame:
    """Net revenue (line totals) per customer country."""
    per_cust = _revenue_per_customer(wh, wh.orders().select("orderid", "customerid"))
    c = wh.customers().select("customerid", "country")
    return (per_cust.join(c, "customerid").groupBy("country")
            .agg(to_double_money(F.sum("v")).alias("revenue")))


def revenue_by_country_year(wh: Warehouse, year: int = 1998) -> DataFrame:
    o = wh.orders(*_year_range(year)).select("orderid", "customerid")
    per_cust = (wh.order_details().select("orderid", "net").join(o, "orderid")
                .groupBy("customerid").agg(F.sum("net").alias("v")))
    c = wh.customers().select("customerid", "country")
    return (per_cust.join(c, "customerid").groupBy("country")
            .agg(to_double_money(F.sum("v")).alias("revenue")))


def revenue_q1_compare(wh: Warehouse, year_x: int = 1997, year_y: int = 1998) -> DataFrame:
    """Jan-Mar revenue of year X vs year Y per country, difference and %
    change (NULL when X has no revenue)."""
    quarter = lambda y: wh.orders(dt.date(y, 1, 1), dt.date(y, 3, 31)).select("orderid", "customerid", "orderdate")
    o = quarter(year_x).unionByName(quarter(year_y))  # two ranges that reach the scan
    j = wh.order_details().select("orderid", F.col("net").alias("v")).join(o, "orderid")
    per_cust = j.groupBy("customerid").agg(
        F.sum(F.when(F.year("orderdate") == year_x, F.col("v"))).alias("vx"),
        F.sum(F.when(F.year("orderdate") == year_y, F.col("v"))).alias("vy"))
    c = wh.customers().select("customerid", "country")
    g = per_cust.join(c, "customerid").groupBy("country").agg(
        F.coalesce(F.sum("vx"), F.lit(0)).alias("vx"), F.coalesce(F.sum("vy"), F.lit(0)).alias("vy"))
    return g.select(
        "country", to_double_money("vx").alias("revenue_x"), to_double_money("vy").alias("revenue_y"),
        to_double_money(F.col("vy") - F.col("vx")).alias("difference"),
        # exact: both sums are whole cents, so the % change is a ratio of integers
        round_ratio(((F.col("vy") - F.col("vx")) * 100).cast("bigint") * 100,
                    (F.col("vx") * 100).cast("bigint")).alias("pct_change"))


def date_parts(wh: Warehouse) -> DataFrame:
    """Per order day: day of year, ISO week and quarter, with the order counts
    of the day, of its week and of its quarter (windows over one row a day)."""
    o = wh.orders().groupBy("orderdate").agg(F.count(F.lit(1)).cast("bigint").alias("n_orders"))
    return o.select("orderdate", F.dayofyear("orderdate").cast("bigint").alias("day_of_year"),
                    F.weekofyear("orderdate").cast("bigint").alias("iso_week"),
                    F.quarter("orderdate").cast("bigint").alias("quarter"), "n_orders",
                    *[F.sum("n_orders").over(Window.partitionBy(F.date_trunc(span, "orderdate"))).alias(f"n_orders_{span}")
                      for span in ("week", "quarter")])


def active_customers(wh: Warehouse) -> DataFrame:
    return wh.orders().agg(F.countDistinct("customerid").cast("bigint").alias("active_customers"))


def order_frequency(wh: Warehouse) -> DataFrame:
    return wh.orders().groupBy("customerid").agg(F.count(F.lit(1)).cast("bigint").alias("n_orders"))


def order_frequency_histogram(wh: Warehouse) -> DataFrame:
    return (order_frequency(wh).groupBy("n_orders")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_customers")))


def unpopular_products(wh: Warehouse) -> DataFrame:
    """Products whose line count is below the average over all products
    (products never ordered count as 0). The average is a scalar subquery,
    evaluated once, so no row is paired with a statistics row."""
    per_product = wh.order_details().groupBy("productid").agg(F.count(F.lit(1)).alias("n"))
    p = wh.products().select("productid", "productname", "categoryname")
    counted = p.join(per_product, "productid", "left").withColumn(
        "order_count", F.coalesce(F.col("n"), F.lit(0)).cast("bigint")).drop("n")
    # one row per product, read by the average and by the filter: write once
    counted = materialize(counted, "product-counts")
    avg_count = counted.agg(F.avg("order_count")).scalar()
    return counted.filter(F.col("order_count") < avg_count)


def random_customers(wh: Warehouse, k: int = 100, salt: str = "cust") -> DataFrame:
    """k draws of a customer id uniformly from the id range [min, max]
    (hash-based, repeatable); draws that hit no customer return nothing."""
    c = wh.customers().select("customerid", "companyname")
    st = scalar_row(c, lo=F.min("customerid"), span=F.max("customerid") - F.min("customerid") + 1)
    draws = wh.spark.range(k).select(
        F.col("id").alias("draw"),
        (st["lo"] + F.pmod(hash_int(salt, F.col("id")), st["span"])).alias("customerid"))
    return draws.join(c, "customerid").select("draw", "customerid", "companyname")



def active_customer_draws(wh: Warehouse, salt: str = "active") -> DataFrame:
    """For each order a customer drawn from those who have ordered at all: their ids have
    gaps, and every draw hits one."""
    orders = wh.orders().select("orderid", "customerid")
    ids, n = islands_and_count(orders, "customerid")
    return pick(orders.select("orderid", F.pmod(hash_int(salt, F.col("orderid")), n).alias("rank")), ids, "rank", "customerid")
