"""A daily rollup of member activity that merges to any period.

Counts and sums of days add up to those of a month or a quarter, distinct members do
not. So each row of the rollup holds its members as an exact bitmap (a bit for each member
number, 32,768 numbers to a bitmap, more bitmaps for more members); bitmaps of days are
merged by OR, and their bits counted. A report over any period reads the rollup, not
the loans; a new or corrected day is one partition of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.scalar import avg_round, pct_round, year_month
from starloom.operators.store import scratch_path
from starloom.sources.io import read_table, write_table
from starloom.sources.tables import REPORT_END, REPORT_START, Warehouse

BY = ["kind", "membershiptype", "most"]


def activity(wh: Warehouse, start: dt.date, end: dt.date) -> DataFrame:
    """One row per loan and successful reservation: day, kind, type, the type's limit, member."""
    loans = wh.book_loans(start, end).select(F.col("loan_date").alias("day"), F.lit("loan").alias("kind"), "membershiptype",
                                             F.col("maxbookloan").alias("most"), "memberid")
    m = wh.members().select("member_key", "memberid", "membershiptype", F.col("maxreservation").alias("most"))
    resv = (wh.reservations(start, end).where(F.upper("reservationstatus") == "SUCCESS").join(m, "member_key")
            .select(F.col("resv_date").alias("day"), F.lit("reservation").alias("kind"), "membershiptype", "most", "memberid"))
    return loans.unionByName(resv)


def daily(rows: DataFrame) -> DataFrame:
    """The rollup of activity rows: per day, kind, type and limit the records and, per
    block of member numbers, the members. Built by partial aggregates."""
    return rows.groupBy("day", *BY, F.bitmap_bucket_number("memberid").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("memberid")).alias("members"), F.count(F.lit(1)).alias("records"))


def merged(rollup: DataFrame, period: Column, name: str = "period") -> DataFrame:
    """The rollup per ``period`` of a day: members (distinct) and records."""
    blocks = rollup.groupBy(period.alias(name), *BY, "block").agg(F.bitmap_or_agg("members").alias("members"), F.sum("records").alias("records"))
    return blocks.groupBy(name, *BY).agg(F.sum(F.bitmap_count("members")).alias("members"), F.sum("records").alias("records"))


def write_rollup(wh: Warehouse, path: str, start: dt.date = REPORT_START, end: dt.date = REPORT_END) -> None:
    """Store the rollup of a window, a partition per day."""
    write_table(daily(activity(wh, start, end)).repartition("day"), path, ["day"])


def renew_days(wh: Warehouse, path: str, first: dt.date, last: dt.date) -> None:
    """Compute the days anew, or add them; files of other days stay."""
    days = daily(activity(wh, first, last)).repartition("day")
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)


def stored_rollup(wh: Warehouse) -> DataFrame:
    path = scratch_path(wh.spark, "rollup")
    write_rollup(wh, path)
    return read(wh.spark, path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).withColumn("day", F.col("day").cast("date"))


def active_members(rollup: DataFrame, period: str = "quarter") -> DataFrame:
    """Members with a loan (a successful reservation) and how many, per period and type."""
    d = F.col("day")
    of = {"month": year_month(d), "quarter": F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string")), "year": F.year(d).cast("string"),
          "window": F.lit("all")}[period]
    return merged(rollup, of).groupBy("period", "kind", "membershiptype").agg(
        F.sum("members").cast("bigint").alias("active_members"), F.sum("records").cast("bigint").alias("records"))


def avg_utilisation(rollup: DataFrame) -> DataFrame:
    """``library.avg_utilisation`` from the rollup: a month's distinct members are its
    member-months, and the limit is the type's."""
    months = merged(rollup, year_month(F.col("day")))
    def part(kind: str, short: str) -> DataFrame:
        return months.where(F.col("kind") == kind).groupBy("membershiptype").agg(
            F.sum("members").alias(f"{short}_member_months"), F.sum("records").alias(f"{short}s"), F.sum(F.col("members") * F.col("most")).alias(f"{short}_limits"))
    j = part("loan", "loan").join(part("reservation", "resv"), "membershiptype", "full_outer")
    cols = []
    for short in ("loan", "resv"):
        n, total, limit = f"{short}_member_months", f"{short}s", f"{short}_limits"
        cols += [F.coalesce(n, F.lit(0)).cast("bigint").alias(n), avg_round(total, n).alias(f"avg_monthly_{short}s"),
                 avg_round(limit, n).alias(f"avg_{short}_limit"), pct_round(total, limit).alias(f"{short}_utilisation_pct")]
    return j.select("membershiptype", *cols)
