"""Fact loads: the sales star and the enrollment fact.

Sales fact grain: one row per de-duplicated order line. The lookups are
arranged so each big input is shuffled as few times as possible: the
order-side keys (customer, date, employee) are resolved on orders, the
product key on lines, and the two halves meet once on the order id. The
calendar (days of the order years) is bounded by construction and broadcast;
customers, products and employees (a user's own table may hold any number) are
left to AQE, which broadcasts them only when measured small.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import net_amount
from starloom.operators.dedup import first_per_pair
from starloom.operators.keys import surrogate_key
from starloom.operators.scd2 import scd2_lookup
from starloom.plans.calendar import date_dim, date_dim_between
from starloom.plans.dims import (DIM_KEY_START, build_dims, customer_dim, employee_dim,
                                 product_dim)
from starloom.sources.tables import Warehouse


def dedup_order_details(wh: Warehouse, lines: DataFrame | None = None) -> DataFrame:
    """NEW_DETAILS: the first line of every (order, product), five columns
    plus the gross and the net amount. ``lines`` may hold the lines of some orders or
    products only: the pair is the group, so the others make no difference."""
    keep = ["orderid", "productid", "unitprice", "quantity", "gross", "discount"]
    first = first_per_pair(wh.order_lines() if lines is None else lines, wh.line_order, keep)
    return first.withColumn("net", net_amount("gross", "discount"))


def sales_fact(wh: Warehouse, details: DataFrame | None = None, cal: DataFrame | None = None,
               cust: DataFrame | None = None, prod: DataFrame | None = None,
               order_window: tuple | None = None) -> DataFrame:
    """SALES_FACT: one row per de-duplicated line with its four keys.

    ``cal`` / ``cust`` / ``prod`` may be filtered dimensions (any extra
    attribute columns they carry are kept on the fact rows); ``order_window``
    = (first day, last day) filters the orders scan. Filtering the inputs
    gives exactly the rows of the full fact that satisfy the filters, since
    every lookup is an inner join and a line's (order, product) pair
    decides its de-duplication.
    """
    build_dims(wh)
    det = dedup_order_details(wh) if details is None else details
    cal = date_dim(wh).select("date_key", "cal_date") if cal is None else cal
    cust = customer_dim(wh).select("customer_key", "customerid") if cust is None else cust
    prod = product_dim(wh).select("product_key", "productid") if prod is None else prod
    emp = employee_dim(wh).select("employee_key", "employeeid")
    cal = F.broadcast(cal)  # days of the order years: bounded
    orders = wh.orders(*order_window) if order_window else wh.orders()
    o = (orders.select("orderid", "customerid", "employeeid", "orderdate")
         .join(cust, "customerid")
         .join(cal, F.col("orderdate") == F.col("cal_date"))
         .join(emp, "employeeid")
         .drop("customerid", "employeeid", "orderdate", "cal_date"))
    lines = det.join(prod, "productid").drop("productid")
    extra = [c for c in o.columns + lines.columns
             if c not in ("orderid", "date_key", "customer_key", "employee_key", "product_key",
                          "unitprice", "gross", "quantity", "discount", "net")]
    return lines.join(o, "orderid").select(
        "date_key", "customer_key", "product_key", "employee_key", "orderid",
        F.col("unitprice").alias("unit_price"), F.col("gross").alias("gross_amount"), F.col("quantity"), F.col("discount"),
        F.col("net").alias("line_total"), *extra)


def star_sales(wh: Warehouse, years=(1998, 2000), countries=("NATION_1", "NATION_2", "NATION_3"),
               categories=("PROMO", "SMALL", "LARGE")) -> DataFrame:
    """Line totals by country, year and category for the chosen members of
    each dimension (the 3-dimensional star query).

    The dimension filters are applied before the fact rows are assembled
    (years also prune the orders scan), and the dimension attributes ride
    along the key lookups, so the fact is never re-joined to its dimensions.
    """
    build_dims(wh)
    window = (dt.date(years[0], 1, 1), dt.date(years[1], 12, 31))
    d = date_dim_between(wh.spark, *window).select("date_key", "cal_date", "cal_year")
    c = (customer_dim(wh).filter(F.col("country").isin(list(countries)))
         .select("customer_key", "customerid", "country"))
    p = (product_dim(wh).filter(F.col("categoryname").isin(list(categories)))
         .select("product_key", "productid", "categoryname"))
    lines = (wh.order_lines().join(p.select("productid"), "productid", "left_semi")
             .join(wh.orders(*window).select("orderid"), "orderid", "left_semi"))
    f = sales_fact(wh, dedup_order_details(wh, lines), cal=d, cust=c, prod=p, order_window=window)
    return (f.groupBy("country", "cal_year", "categoryname")
            .agg(F.sum("line_total").alias("total_sales"))
            .select("country", "cal_year", "categoryname",
                    F.col("total_sales").cast("double").alias("total_sales"))
            .orderBy("country", "cal_year", "categoryname"))


def enrollment_fact(wh: Warehouse, literal_course_join: bool = False) -> DataFrame:
    """ENROLLMENT_FACT: date key = yyyymmdd of the register day (kept as a
    semi join on the calendar), total fees = fee per credit x credit hours.

    The course version is the one valid on the register day; the source's
    plain join on course id (every version, fan-out) is available with
    ``literal_course_join=True``.
    """
    e = wh.enrollments().withColumn("register_date", F.to_date("register_ts"))
    with ThreadPoolExecutor(max_workers=2) as pool:   # two independent key builds
        fs = pool.submit(surrogate_key, wh.students().select("s_id"), ["s_id"], "s_key",
                         DIM_KEY_START)
        fc = pool.submit(surrogate_key, wh.courses(), ["course_id", "effective_start_date"],
                         "course_key", DIM_KEY_START)
        students, courses = fs.result(), fc.result()
    cal = F.broadcast(date_dim(wh).select("cal_date"))
    j = e.join(students, "s_id")
    if literal_course_join:
        j = j.join(courses, "course_id")
    else:
        j = scd2_lookup(j, courses, "course_id", "register_date")
    j = j.join(cal, F.col("register_date") == F.col("cal_date"), "left_semi")
    return j.select(
        "s_key", "course_key",
        F.date_format("register_date", "yyyyMMdd").cast("bigint").alias("date_key"),
        F.col("se_id").cast("bigint").alias("se_id"),
        "register_date", "grade", "fee_per_credit", "credit_hour",
        (F.col("fee_per_credit") * F.col("credit_hour")).cast("decimal(18,2)").alias("total_fees"))

