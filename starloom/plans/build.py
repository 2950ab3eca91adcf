"""Warehouse build: write the star schema once, query it many times.

At scale the sales star is a batch load, not something each report
recomputes: dimensions and the fact are written as parquet tables (the
fact partitioned by order year, so a year filter prunes whole
directories), and the reports read the written tables. Writing also cuts
the lineage of the surrogate-key and de-duplication steps.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.calendar import date_dim_holidays
from starloom.plans.dims import build_dims, customer_dim, employee_dim, product_dim
from starloom.plans.facts import sales_fact
from starloom.operators.store import scratch_path
from starloom.sources.io import read_table, write_table
from starloom.sources.partitions import delete_rows, merge_rows, update_rows
from starloom.sources.tables import Warehouse

STAR_TABLES = ["date_dim", "customer_dim", "employee_dim", "product_dim", "sales_fact"]


def build_star(wh: Warehouse, out_dir: str) -> dict[str, str]:
    """Write the four dimensions and the sales fact under ``out_dir``."""
    out = out_dir.rstrip("/")
    paths = {t: f"{out}/{t}" for t in STAR_TABLES}
    build_dims(wh)
    dims = {"date_dim": date_dim_holidays(wh), "customer_dim": customer_dim(wh),
            "employee_dim": employee_dim(wh), "product_dim": product_dim(wh)}
    # four independent writes: submit them together
    with ThreadPoolExecutor(max_workers=len(dims)) as pool:
        for f in [pool.submit(write_table, df, paths[name]) for name, df in dims.items()]:
            f.result()
    cal = read_table(wh.spark, paths["date_dim"]).select("date_key", "cal_date", "cal_year")
    # date keys follow the days: a task writes one or two years, not a file for each
    fact = sales_fact(wh, cal=cal).repartitionByRange("date_key", "orderid")
    write_table(fact, paths["sales_fact"], partition_by=["cal_year"])
    return paths


def star_sales_from_tables(spark, paths: dict[str, str], years=(1998, 2000),
                           countries=("NATION_1", "NATION_2", "NATION_3"),
                           categories=("PROMO", "SMALL", "LARGE")) -> DataFrame:
    """The star query over written tables: the year range prunes fact
    partitions, the other dimension filters become broadcast or runtime
    filters on the fact."""
    f = read_table(spark, paths["sales_fact"]).filter(F.col("cal_year").between(*years))
    c = (read_table(spark, paths["customer_dim"]).filter(F.col("country").isin(list(countries)))
         .select("customer_key", "country"))
    p = (read_table(spark, paths["product_dim"]).filter(F.col("categoryname").isin(list(categories)))
         .select("product_key", "categoryname"))
    j = f.join(c, "customer_key").join(p, "product_key")
    return (j.groupBy("country", "cal_year", "categoryname")
            .agg(F.sum("line_total").cast("double").alias("total_sales"))
            .select("country", F.col("cal_year").cast("bigint"), "categoryname", "total_sales"))


def orders_after_changes(wh: Warehouse) -> DataFrame:
    """A stored order table by year, after a merge of one month (changed and new orders), an
    update of another and a delete of a third; each rewrites one year's files."""
    spark, by = wh.spark, ["order_year"]
    path = scratch_path(spark, "orders")
    day = F.col("orderdate")
    orders = wh.orders().select("orderid", "customerid", "orderdate", F.year("orderdate").alias("order_year"))
    write_table(orders.repartitionByRange("order_year", "orderid"), path, by)
    month = orders.where(day.between(F.lit(dt.date(1997, 3, 1)), F.lit(dt.date(1997, 3, 31))))
    changes = month.withColumn("customerid", F.col("customerid") + 1).unionByName(month.withColumn("orderid", F.col("orderid") + 1_000_000_000))
    merge_rows(spark, path, changes, ["orderid"], by)
    update_rows(spark, path, day.between(F.lit(dt.date(1998, 2, 1)), F.lit(dt.date(1998, 2, 28))), {"customerid": F.lit(0)}, by)
    delete_rows(spark, path, day.between(F.lit(dt.date(1999, 1, 1)), F.lit(dt.date(1999, 1, 31))), by)
    return read_table(spark, path).select("orderid", "customerid", "orderdate", F.col("order_year").cast("bigint").alias("order_year"))
