"""The written star schema answers the star query like the in-plan pipeline."""

import contextlib
import io
import tempfile

import pytest

from conftest import SMALL
from starloom.plans.build import build_star, star_sales_from_tables
from starloom.plans.facts import star_sales
from starloom.sources.io import append_by_name, read_table, write_table
from starloom.sources.tables import Warehouse


def test_star_over_written_tables(spark):
    out = tempfile.mkdtemp(prefix="starloom-build-")
    paths = build_star(Warehouse(spark, SMALL), out)
    stored = star_sales_from_tables(spark, paths)
    direct = star_sales(Warehouse(spark, SMALL))
    assert stored.count() > 0
    assert sorted(stored.collect()) == sorted(direct.select(*stored.columns).collect())
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        stored.explain("formatted")
    assert "PartitionFilters: [isnotnull(cal_year" in buf.getvalue()


def test_append_by_name(spark):
    path = tempfile.mkdtemp(prefix="starloom-append-") + "/t"
    write_table(spark.createDataFrame([(1, "a")], "k long, v string"), path)
    append_by_name(spark.createDataFrame([("b", 2)], "v string, k long"), path, spark)
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        append_by_name(spark.createDataFrame([(3,)], "k long"), path, spark)
    with pytest.raises(ValueError):
        append_by_name(spark.createDataFrame([(3, "c", 1)], "k long, v string, x long"), path, spark)


def test_failed_overwrite_keeps_the_old_rows(spark):
    from pyspark.sql import functions as F
    path = tempfile.mkdtemp(prefix="starloom-swap-") + "/t"
    write_table(spark.range(5).toDF("k"), path)
    with pytest.raises(Exception, match="on purpose"):
        write_table(spark.range(3).select(F.raise_error(F.lit("on purpose")).cast("long").alias("k")), path)
    assert read_table(spark, path).count() == 5
    write_table(read_table(spark, path).where("k < 2"), path)
    assert read_table(spark, path).count() == 2


def test_holidays_from_a_csv_file(spark):
    import datetime as dt
    import os

    from starloom.plans import calendar
    from starloom.sources.io import read_holidays
    d = tempfile.mkdtemp(prefix="starloom-hol-")
    with open(os.path.join(d, "h.csv"), "w") as fh:
        fh.write("holiday_date,festive_event\n2024-05-01,Labour Day\n2024-05-01,Wesak Day\n")
    dim = calendar.date_dim_between(spark, dt.date(2024, 4, 30), dt.date(2024, 5, 2))
    out = {r.cal_date: r.festive_event for r in
           calendar.apply_holidays(dim, read_holidays(spark, d)).collect()}
    assert out[dt.date(2024, 5, 1)] == "Labour Day; Wesak Day" and out[dt.date(2024, 4, 30)] is None


def test_holidays_with_dates_in_another_form(spark, tmp_path):
    import datetime as dt

    import pytest

    from starloom.sources.io import read_holidays
    (tmp_path / "h.csv").write_text("holiday_date,festive_event\n31/08/2024,National Day\n")
    assert [tuple(r) for r in read_holidays(spark, str(tmp_path), date_format="dd/MM/yyyy").collect()] == [
        (dt.date(2024, 8, 31), "National Day")]
    with pytest.raises(Exception, match="MALFORMED"):
        read_holidays(spark, str(tmp_path)).collect()


def test_scd2_sees_nulls_and_empty_texts_as_different(spark):
    import datetime as dt

    from starloom.operators import scd2
    cols = "k long, a string, b long"
    first = scd2.initial_versions(spark.createDataFrame([(1, None, 1), (2, "", 2), (3, "x", None), (4, None, None)], cols),
                                  ["k"], dt.date(2000, 1, 1))
    new = spark.createDataFrame([(1, "", 1), (2, None, 2), (3, "x", None), (5, None, None)], cols)
    out = scd2.scd2_apply(first, new, ["k"], ["a", "b"], dt.date(2001, 1, 1))
    assert sorted((r.k, r.sk, r.current_flag) for r in out.collect()) == [
        (1, 1, "N"), (1, 5, "Y"), (2, 2, "N"), (2, 6, "Y"), (3, 3, "Y"), (4, 4, "Y"), (5, 7, "Y")]


def test_checks_find_what_breaks_them(spark):
    from starloom.operators import quality
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id long, parent long")
    parent = spark.createDataFrame([(1, "a"), (1, "bbbb"), (2, None)], "parent long, name string")
    assert [r.id for r in quality.fk_violations(child, parent, "parent").collect()] == [2]
    assert [tuple(r) for r in quality.pk_violations(parent, ["parent"]).collect()] == [(1, 2)]
    assert [tuple(r) for r in quality.null_violations(parent, ["parent", "name"]).collect()] == [("parent", 0), ("name", 1)]
    assert [tuple(r) for r in quality.length_violations(parent, {"name": 3}).collect()] == [("name", 1)]


def test_written_star_keeps_its_keys(spark, tmp_path):
    from conftest import SMALL
    from starloom.operators import quality
    from starloom.plans.build import build_star
    from starloom.sources.io import read_table
    from starloom.sources.tables import Warehouse
    t = {k: read_table(spark, p) for k, p in build_star(Warehouse(spark, SMALL), str(tmp_path)).items()}
    fact = t["sales_fact"]
    assert fact.count() > 0 and not quality.pk_violations(fact, ["orderid", "product_key"]).count()
    for dim, key in (("date_dim", "date_key"), ("customer_dim", "customer_key"), ("product_dim", "product_key"),
                     ("employee_dim", "employee_key")):
        assert not quality.pk_violations(t[dim], [key]).count()
        assert not quality.fk_violations(fact, t[dim], key).count()


def test_processing_times_and_reservations_over_the_limit(spark, tmp_path):
    import datetime as dt

    from starloom.plans import library
    from starloom.sources.roles import RoleWarehouse
    day, other = dt.date(1999, 5, 1), dt.date(1999, 5, 20)
    for name, rows, schema in (
            ("members", [(1, 7, "Gold", 3, 2, 14, None, "A"), (2, 8, "Gold", 1, 4, 14, None, "A")],
             "member_key long, memberid long, membershiptype string, maxbookloan long, maxreservation long, loanduration long, dob date, region string"),
            ("book_loans", [(1, 1, 1, day, 5, 0), (2, 1, 1, day, 5, 0)],
             "member_key long, booktitle_key long, staff_key long, loan_date date, loandays long, overduedays long"),
            ("reservations", [(1, 1, day, 1, "Success", 1, 3, 4), (1, 1, other, 2, "success", 2, 2, 4), (2, 1, day, 3, "Success", 6, 1, 7),
                              (2, 1, day, 4, "Cancelled", 2, None, 2)],
             "member_key long, staff_key long, resv_date date, reservationid long, reservationstatus string, reservetoreadydays long, "
             "readytosuccessdays long, totaldays long")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    wh, span = RoleWarehouse(spark, str(tmp_path)), (dt.date(1999, 5, 1), dt.date(1999, 5, 31))
    over = sorted(tuple(r) for r in library.high_utilisation_members(wh, 90, *span).collect())
    assert over == [("Gold", "loan", 1, 1), ("Gold", "reservation", 1, 1)]
    u = library.avg_utilisation(wh, *span).first()
    # loans 2 against limits 3 + 1; reservations 2 + 1 against 2 + 4
    assert (u.avg_loan_limit, u.loan_utilisation_pct, u.avg_resv_limit, u.resv_utilisation_pct) == (2.0, 50.0, 3.0, 50.0)
    times = {r.reservationstatus: tuple(r)[1:] for r in library.reservation_processing(wh, *span).collect()}
    assert times == {"Success": (2, 3.5, 2.0, 5.5), "success": (1, 2.0, 2.0, 4.0), "Cancelled": (1, 2.0, None, 2.0)}


def test_a_refused_rename_leaves_both_tables(spark, tmp_path, monkeypatch):
    """Hadoop's rename returns False instead of raising: the new table must not end up
    inside the old one."""
    from starloom.sources import io
    path = str(tmp_path / "t")
    io.write_table(spark.range(3), path)

    class Stubborn:
        def __init__(self, fs):
            self.fs = fs

        def rename(self, a, b):
            return False

        def __getattr__(self, name):
            return getattr(self.fs, name)
    monkeypatch.setattr(io, "_file_system", lambda spark, p, real=io._file_system: Stubborn(real(spark, p)))
    with pytest.raises(OSError, match="complete at"):
        io.write_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    assert sorted(x.name.split("-")[0] for x in tmp_path.iterdir()) == ["t", "t.new"]
