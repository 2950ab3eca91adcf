"""Members with several versions, staff whose id is not the key, and rows that the
checks must find; hand-made role tables."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.keys import materialize, release_stored
from starloom.plans import calendar, library
from starloom.sources.roles import RoleWarehouse
from starloom.sources.tables import Warehouse

START, END = dt.date(2000, 1, 1), dt.date(2000, 3, 31)


def role_tables(spark, path):
    day = dt.date(2000, 2, 5)
    tables = {
        "members": ([(k, m, "Gold", 2, 2, 14, None, None) for k, m in ((1, 7), (2, 7), (3, 8))],
                    "member_key long, memberid long, membershiptype string, maxbookloan long, maxreservation long, loanduration long, dob date, region string"),
        "staff": ([(1, 900, 10.0)], "staff_key long, staffid long, salary double"),
        "book_loans": ([(1, 1, 1, day, 3, 0), (2, 1, 1, day, 3, 0), (3, 1, 1, day, 3, 0)],
                       "member_key long, booktitle_key long, staff_key long, loan_date date, loandays long, overduedays long"),
        "reservations": ([(1, 1, day, 1, "Success", 1), (2, 1, day, 2, "Success", 1)],
                         "member_key long, staff_key long, resv_date date, reservationid long, reservationstatus string, totaldays long"),
        "orders": ([(1, 1, 1, dt.date(1999, 5, 1), None, None, 1)],
                   "orderid long, customerid long, employeeid long, orderdate date, requireddate date, shippeddate date, shipvia long"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}")
    return RoleWarehouse(spark, str(path))


def test_versions_of_a_member_count_once(spark, tmp_path):
    wh = role_tables(spark, tmp_path)
    r = library.membership_utilisation_month(wh, START, END).collect()
    assert [(x.membershiptype, x.bookloaninmonths, x.hit_maxbookuti_perc, x.hit_maxresruti_perc) for x in r] == [("Gold", 3, 50.0, 100.0)]
    u = library.avg_utilisation(wh, START, END).first()
    assert (u.loan_member_months, u.resv_member_months, u.resv_utilisation_pct) == (2, 1, 100.0)


def test_staff_are_reported_by_id(spark, tmp_path):
    wh = role_tables(spark, tmp_path)
    assert [tuple(r) for r in library.staff_member_interactions(wh, START, END).collect()] == [(900, 2)]


def test_calendar_covers_every_fact(spark, tmp_path):
    wh = role_tables(spark, tmp_path)
    assert tuple(calendar.calendar_bounds(wh).first()) == (dt.date(1999, 1, 1), dt.date(2000, 12, 31))


def test_checks_see_customers_without_a_nation(spark, tmp_path):
    src = "/root/testdata/sf0.001"
    for t in ("nation", "region"):
        spark.read.parquet(f"{src}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    spark.read.parquet(f"{src}/customer.parquet").withColumn(
        "c_nationkey", F.when(F.col("c_custkey") == 4, F.lit(99).cast("bigint")).otherwise(F.col("c_nationkey"))) \
        .write.parquet(f"{tmp_path}/customer.parquet")
    c = Warehouse(spark, str(tmp_path)).customers()
    got = {r.column_name: r.n_violations for r in quality.null_violations(c, ["country", "city"]).collect()}
    assert got == {"country": 1, "city": 1}


def test_checks_find_violations(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id long, k long")
    parent = spark.createDataFrame([(10,), (10,)], "k long")
    assert [r.id for r in quality.fk_violations(child, parent, "k").collect()] == [2]
    got = {r.column_name: r.n_violations for r in quality.length_violations(
        spark.createDataFrame([("abc",), ("ab",), (None,)], "t string"), {"t": 2}).collect()}
    assert got == {"t": 1}


def test_stored_copies_can_be_released(spark):
    release_stored(spark)
    materialize(spark.range(3).toDF("k"))
    assert release_stored(spark) == 1 and release_stored(spark) == 0
