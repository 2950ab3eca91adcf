"""The daily rollup of members, and regional holidays."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import normalised
from conftest import SMALL
from starloom.plans import calendar, library, rollup
from starloom.sources.tables import Warehouse
from test_loads import files

START, END = dt.date(1999, 1, 1), dt.date(1999, 6, 30)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("rollup") / "r"
    rollup.write_rollup(Warehouse(spark, SMALL), str(path), START, END)
    return path


def test_any_period_counts_members_once(spark, stored):
    """Months, quarters, years and the whole window from one rollup, against the loans."""
    rows = rollup.activity(Warehouse(spark, SMALL), START, END)
    days = {"month": F.date_format("day", "yyyy-MM"), "quarter": F.concat(F.year("day"), F.lit("-Q"), F.quarter("day")), "year": F.year("day").cast("string"),
            "window": F.lit("all")}
    for period, of in days.items():
        got = rollup.active_members(rollup.read(spark, str(stored)), period)
        want = rows.groupBy(of.alias("period"), "kind", "membershiptype").agg(F.countDistinct("memberid", "most").alias("active_members"), F.count("*").alias("records"))
        assert normalised(got.columns, got.collect()) == normalised(want.columns, want.collect()) and got.count() > 3


def test_bitmaps_hold_members_of_any_number(spark):
    ids = [0, 1, 32767, 32768, 32769, 5_000_000_000, 5_000_000_000, 7]
    rows = spark.createDataFrame([(dt.date(2000, 1, 1 + i % 3), "loan", "A", 1, m) for i, m in enumerate(ids)], "day date, kind string, membershiptype string, most long, memberid long")
    got = rollup.active_members(rollup.daily(rows), "year").collect()
    assert [(r["active_members"], r["records"]) for r in got] == [(len(set(ids)), len(ids))]


def test_a_renewed_day_touches_its_files_alone(spark, stored):
    before = files(stored)
    wh = Warehouse(spark, SMALL)
    rollup.renew_days(wh, str(stored), dt.date(1999, 3, 5), dt.date(1999, 3, 5))
    rollup.renew_days(wh, str(stored), dt.date(1999, 7, 1), dt.date(1999, 7, 1))
    same = {f for f in before if not f.startswith("day=1999-03-05")}
    assert same <= files(stored) and {f.split("/")[0] for f in files(stored) - same} == {"day=1999-03-05", "day=1999-07-01"}
    got = rollup.read(spark, str(stored))
    want = rollup.daily(rollup.activity(wh, START, dt.date(1999, 7, 1)))
    assert normalised(want.columns, got.select(want.columns).collect()) == normalised(want.columns, want.collect())


def test_regional_events_never_multiply_loans(spark):
    wh = Warehouse(spark, SMALL)
    with_bridge = library.overdue_by_regional_holiday(wh).agg(F.sum("total_loans"), F.sum("overdue_loans")).first()
    without = library.overdue_by_period(wh, "year", False).agg(F.sum("total_loans"), F.sum("overdue_loans")).first()
    assert tuple(with_bridge) == tuple(without)


def test_regional_bridge(spark):
    days = calendar.date_dim_between(spark, dt.date(2000, 5, 1), dt.date(2000, 5, 2))
    events = spark.createDataFrame([(None, 5, 1, "all"), ("A", 5, 1, "own"), ("A", 5, 1, "own"), ("B", 5, 2, "x" * 40), ("B", 6, 1, "later"), ("C", 1, 1, "c")],
                                   "region string, h_month int, h_day int, festive_event string")
    got = sorted((r["cal_date"].day, r["region"], r["festive_event"]) for r in calendar.regional_holidays(days, events).collect())
    assert got == [(1, "A", "all"), (1, "A", "own"), (1, "B", "all"), (1, "C", "all"), (2, "B", "x" * 25)]
