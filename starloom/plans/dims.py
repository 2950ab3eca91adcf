"""Cleaned sources and the customer / employee / product dimensions.

Each dimension is a projection of its cleaned source plus a dense
surrogate key starting at 1234, numbered in natural-key order.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import concat_nullsafe
from starloom.operators.keys import KeyMap, surrogate_key
from starloom.operators.store import scratch_path
from starloom.sources.tables import Warehouse

DIM_KEY_START = 1234
DEFAULT_POSTALCODE = "53300"


def clean_customers(customers: DataFrame, default_postalcode: str = DEFAULT_POSTALCODE) -> DataFrame:
    """``UPDATE .. SET region = city WHERE region IS NULL`` and
    ``SET postalcode = '53300' WHERE postalcode IS NULL``."""
    return (customers.withColumn("region", F.coalesce("region", "city"))
            .withColumn("postalcode", F.coalesce(F.col("postalcode"), F.lit(default_postalcode))))


def customer_dim(wh: Warehouse) -> DataFrame:
    return wh.memo("customer_dim", lambda: _customer_dim(wh))


def _customer_dim(wh: Warehouse) -> DataFrame:
    c = clean_customers(wh.customers())
    out = c.select("customerid",
                   *[F.upper(x).alias(x) for x in
                     ("companyname", "country", "region", "city", "postalcode")])
    return surrogate_key(out, ["customerid"], "customer_key", DIM_KEY_START).select(
        "customer_key", "customerid", "companyname", "country", "region", "city", "postalcode")


def employee_dim(wh: Warehouse) -> DataFrame:
    return wh.memo("employee_dim", lambda: _employee_dim(wh))


def _employee_dim(wh: Warehouse) -> DataFrame:
    e = wh.employees().select(
        "employeeid", concat_nullsafe("firstname", F.lit(" "), "lastname").alias("emp_name"),
        "hiredate", "country", "city")
    return surrogate_key(e, ["employeeid"], "employee_key", DIM_KEY_START).select(
        "employee_key", "employeeid", "emp_name", "hiredate", "country", "city")


def product_dim(wh: Warehouse) -> DataFrame:
    """Product snowflake flattened: product -> category -> supplier (inner
    joins: a product without category or supplier is not loaded)."""
    return wh.memo("product_dim", lambda: _product_dim(wh))


def _product_dim(wh: Warehouse) -> DataFrame:
    p = wh.products()
    s = wh.suppliers().select(F.col("supplierid").alias("s_id"),
                              F.col("companyname").alias("sup_companyname"),
                              F.col("country").alias("sup_country"),
                              F.col("city").alias("sup_city"))
    j = p.filter(F.col("categoryname").isNotNull()).join(s, p.supplierid == s.s_id)
    out = j.select("productid",
                   F.upper("productname").alias("productname"),
                   F.upper("quantityperunit").alias("quantityperunit"),
                   F.col("discontinued").cast("bigint").alias("discontinued"),
                   F.upper("categoryname").alias("categoryname"),
                   F.upper("sup_companyname").alias("sup_companyname"),
                   F.upper("sup_country").alias("sup_country"),
                   F.upper("sup_city").alias("sup_city"))
    return surrogate_key(out, ["productid"], "product_key", DIM_KEY_START).select(
        "product_key", "productid", "productname", "quantityperunit", "discontinued",
        "categoryname", "sup_companyname", "sup_country", "sup_city")


def build_dims(wh: Warehouse, names=("customer_dim", "product_dim", "employee_dim")) -> None:
    """Key the given dimensions concurrently. Each key build is a few
    independent Spark jobs; submitting them from separate driver threads
    lets the scheduler overlap them instead of running them back to back."""
    builders = {"customer_dim": customer_dim, "product_dim": product_dim,
                "employee_dim": employee_dim}
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        for f in [pool.submit(builders[n], wh) for n in names]:
            f.result()


def customer_keys_over_loads(wh: Warehouse, first_until: dt.date) -> DataFrame:
    """Two loads of a stored key map: the customers that have ordered up to a day,
    then all. The first load's keys stay, the others go on from there."""
    path = scratch_path(wh.spark, "key-map")
    table = KeyMap(wh.spark, f"starloom_keys_{uuid.uuid4().hex}", ["customerid"], "customer_key", DIM_KEY_START, path=path)
    n = table.load(wh.orders(end=first_until).select("customerid"))
    table.load(wh.customers().select("customerid"))
    wh.spark.sql(f"DROP TABLE {table.name}")  # the files stay
    load = F.when(F.col("customer_key") < DIM_KEY_START + n, 1).otherwise(2).cast("bigint")
    return wh.spark.read.parquet(path).select("customerid", "customer_key", load.alias("load"))
