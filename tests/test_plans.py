"""Physical-plan checks: pushdown, pruning, broadcast only where bounded,
partial aggregation before shuffles."""

import contextlib
import io

from conftest import SMALL
from starloom.plans import facts, library, retail
from starloom.sources.tables import Warehouse


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_year_filter_reaches_the_orders_scan(spark):
    p = plan(retail.customers_over_threshold(Warehouse(spark, SMALL), 1995))
    assert "GreaterThanOrEqual(o_orderdate,1995-01-01T00:00)" in p
    assert "LessThan(o_orderdate,1996-01-01T00:00)" in p


def test_loan_window_reaches_the_lineitem_scan(spark):
    p = plan(library.overdue_month(Warehouse(spark, SMALL)))
    assert "GreaterThanOrEqual(l_shipdate,1999-01-01T00:00)" in p
    assert "LessThan(l_shipdate,2000-07-01T00:00)" in p


def test_lineitem_scan_is_pruned(spark):
    p = plan(retail.revenue_by_country(Warehouse(spark, SMALL)))
    schemas = [line for line in p.splitlines() if line.startswith("ReadSchema: struct<l_")]
    assert schemas and all("l_comment" not in s and "l_shipdate" not in s for s in schemas)


def test_dedup_aggregates_map_side_before_the_shuffle(spark):
    p = plan(facts.dedup_order_details(Warehouse(spark, SMALL)), "simple")
    assert "partial_min" in p
    assert "Window" not in p


def test_fact_has_no_single_partition_shuffle_of_lines(spark):
    df = facts.sales_fact(Warehouse(spark, SMALL))
    p = plan(df, "simple")
    # single-partition exchanges only carry one row per task: the
    # ranges' states of the surrogate keys, or the partial
    # results of a global aggregate (calendar bounds), or a dimension with
    # fewer rows than a range of the scan is worth -- never fact rows
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[i:i + 4])
            assert "_scan_range" in below or "_scan_tie" in below and "FileScan" in below or "HashAggregate(keys=[], functions=[partial_" in below, below
    assert "BroadcastHashJoin" in p


def test_calendar_and_employee_are_broadcast_in_the_fact(spark):
    p = plan(facts.sales_fact(Warehouse(spark, SMALL)), "simple")
    assert p.count("BroadcastExchange") >= 2


def test_no_cartesian_nested_loop_or_python_in_any_query(spark):
    import __spark_entry__ as entry

    from plan_audit import BAD
    for name, fn in sorted(entry.queries().items()):
        p = plan(fn(spark, SMALL), "simple")
        found = [b for b in BAD if b in p]
        assert not found, f"{name}: {found}"


def test_calendars_hold_dates_and_no_scan_of_the_facts(spark):
    import datetime as dt

    from starloom.plans import calendar
    known = Warehouse(spark, SMALL, days=(dt.date(1995, 1, 1), dt.date(2001, 12, 31)))
    looked = Warehouse(spark, SMALL)
    for wh in (known, looked):
        for df in (calendar.date_dim(wh), calendar.date_dim_holidays(wh), retail.dates_of_year(wh, 1998), calendar.mark_holiday(calendar.date_dim(wh), dt.date(2001, 1, 1)),
                   calendar.academic_year(calendar.date_dim(wh))):
            assert "FileScan" not in plan(df, "simple")
    assert calendar.date_dim(known).collect() == calendar.date_dim(looked).collect()


def test_star_and_window_reports_scan_the_lines_as_often_as_they_need(spark):
    scans = [x for x in plan(facts.star_sales(Warehouse(spark, SMALL)), "simple").splitlines() if "FileScan" in x and "lineitem.parquet" in x]
    assert len(scans) == 1
    for period in ("event", "holiday", "academic_year"):
        text = plan(library.overdue_by_period(Warehouse(spark, SMALL), period, False), "simple")
        assert len([x for x in text.splitlines() if "FileScan" in x and "lineitem.parquet" in x]) == 1


def test_interactions_look_members_up_once(spark):
    text = plan(library.staff_member_interactions(Warehouse(spark, SMALL)), "simple")
    assert len([x for x in text.splitlines() if "FileScan" in x and "customer.parquet" in x]) == 1
