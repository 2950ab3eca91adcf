"""Edge cases the supplied tables do not contain, on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.functions.scalar import age_band, age_years, concat_nullsafe, pct_round, round_ratio
from starloom.plans import calendar, library
from starloom.plans.dims import clean_customers
from starloom.sources.tables import Warehouse

D = dt.date
LOAN_SCHEMA = ("member_key long, memberid long, membershiptype string, maxbookloan long, "
               "maxreservation long, loanduration long, dob date, region string, booktitle_key long, "
               "staff_key long, loan_date date, orderkey long, linenumber int, loandays long, "
               "overduedays long")
RESV_SCHEMA = ("member_key long, staff_key long, resv_date date, reservationid long, "
               "reservationstatus string, totaldays long")


class FakeWarehouse(Warehouse):
    """A warehouse whose roles are given DataFrames (no parquet)."""

    def __init__(self, spark, **frames):
        super().__init__(spark, "/nonexistent")
        self.frames = frames

    def staff_loans(self, start=None, end=None):
        return self.book_loans(start, end).select("staff_key", "loan_date")

    def book_loans(self, start=None, end=None):
        df = self.frames["loans"]
        if start is not None:
            df = df.filter(F.col("loan_date").between(F.lit(start), F.lit(end)))
        return df

    def reservations(self, start=None, end=None):
        df = self.frames["resv"]
        if start is not None:
            df = df.filter(F.col("resv_date").between(F.lit(start), F.lit(end)))
        return df

    def staff(self):
        return self.frames["staff"]

    def members(self):
        return self.frames["members"]


def _loan(member, mtype, maxb, day, overdue, staff=1, dob=None, loandays=10):
    return (member, member, mtype, maxb, 1, 14, dob, "ASIA", 1, staff, day, member, 1, loandays, overdue)


def test_round_ratio_half_away_from_zero(spark):
    rows = spark.range(1).select(
        round_ratio(F.lit(1), F.lit(8)).alias("a"), round_ratio(F.lit(-1), F.lit(8)).alias("b"),
        round_ratio(F.lit(2), F.lit(3)).alias("c"), round_ratio(F.lit(5), F.lit(0)).alias("d"),
        pct_round(F.lit(1), F.lit(3)).alias("e")).first()
    assert (rows.a, rows.b, rows.c, rows.d, rows.e) == (0.13, -0.13, 0.67, None, 33.33)


def test_age_band_boundaries(spark):
    ref = D(2000, 6, 30)
    ages = [17, 18, 25, 26, 40, 41, 60, 61]
    rows = [(D(2000 - a, 6, 30),) for a in ages] + [(None,)]
    df = spark.createDataFrame(rows, "dob date").select(
        age_years(ref, F.col("dob")).alias("age"), age_band(age_years(ref, F.col("dob"))).alias("band"))
    got = [(r.age, r.band) for r in df.collect()]
    assert got == [(17, "<18"), (18, "18-25"), (25, "18-25"), (26, "26-40"), (40, "26-40"),
                   (41, "41-60"), (60, "41-60"), (61, "60+"), (None, "Unknown")]
    # one day short of a birthday is still the younger age
    one = spark.createDataFrame([(D(1982, 7, 1),)], "dob date").select(age_years(ref, F.col("dob"))).first()[0]
    assert one == 17


def test_concat_nullsafe(spark):
    r = spark.range(1).select(concat_nullsafe(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))).first()[0]
    assert r == "ab"


def test_clean_customers(spark):
    df = spark.createDataFrame([(1, "KL", None, None), (2, "PJ", "SEL", "46000")],
                               "customerid long, city string, region string, postalcode string")
    got = {r.customerid: (r.region, r.postalcode) for r in clean_customers(df).collect()}
    assert got == {1: ("KL", "53300"), 2: ("SEL", "46000")}


def test_date_dim_reference_range(spark):
    dim = calendar.date_dim_between(spark, D(2000, 1, 1), D(2025, 12, 31))
    assert dim.count() == 9497
    rows = {r.cal_date: r for r in dim.filter(F.col("cal_date").isin(
        D(2000, 2, 29), D(2023, 1, 1), D(2023, 7, 1), D(2023, 7, 31))).collect()}
    leap = rows[D(2000, 2, 29)]
    assert leap.day_num_year == 60 and leap.last_day_ind == "Y" and leap.date_key == 100001 + 59
    jan1 = rows[D(2023, 1, 1)]     # a Sunday: ISO week 52 of 2022
    assert (jan1.day_week, jan1.cal_week_year, jan1.weekday_ind) == (1, 52, "N")
    assert jan1.cal_week_end_date == D(2023, 1, 7)          # the formula lands on Saturday
    jul = rows[D(2023, 7, 1)]
    assert (jul.full_desc, jul.month_name, jul.cal_year_month, jul.cal_year_quarter) == \
        ("2023 July 01", "JULY", "2023-07", "2023-Q3")
    assert rows[D(2023, 7, 31)].weekday_ind == "Y"         # Monday


def test_two_holidays_on_one_day(spark):
    dim = calendar.date_dim_between(spark, D(2024, 4, 30), D(2024, 5, 2))
    h = spark.createDataFrame([(D(2024, 5, 1), "Labour Day"), (D(2024, 5, 1), "A very long festival name, and on"), (D(1999, 1, 1), "Outside")],
                              "holiday_date date, festive_event string")
    out = {r.cal_date: (r.holiday_ind, r.festive_event) for r in calendar.apply_holidays(dim, h).collect()}
    assert out[D(2024, 4, 30)] == ("N", None)
    assert out[D(2024, 5, 1)] == ("Y", "A very long festival name; Labour Day")
    assert len(out) == 3


def test_academic_year_windows(spark):
    dim = calendar.date_dim_between(spark, D(2025, 6, 15), D(2026, 6, 30))
    got = {r.cal_date: r.acad_year for r in calendar.academic_year(dim).collect()}
    assert got[D(2025, 6, 15)] is None and got[D(2025, 6, 16)] == "2025/26"
    assert got[D(2026, 4, 25)] == "2025/26" and got[D(2026, 4, 26)] is None
    rule = {r.cal_date: r.acad_year for r in calendar.academic_year_rule(dim).collect()}
    assert rule[D(2025, 6, 16)] == "2025/26" and rule[D(2026, 5, 1)] is None


def _staff_wh(spark, staff_rows, loans_rows, resv_rows=()):
    import decimal
    staff_rows = [(a, b, None if c is None else decimal.Decimal(c)) for a, b, c in staff_rows]
    staff = spark.createDataFrame(staff_rows, "staff_key long, staffid long, salary decimal(10,2)")
    loans = spark.createDataFrame(loans_rows, LOAN_SCHEMA)
    resv = spark.createDataFrame(list(resv_rows), RESV_SCHEMA)
    return FakeWarehouse(spark, staff=staff, loans=loans, resv=resv)


def test_staff_salary_not_positive_and_null(spark):
    day = D(1999, 5, 1)
    wh = _staff_wh(spark, [(1, 1, 100), (2, 2, 0), (3, 3, None), (4, 4, -5)],
                   [_loan(10, "Basic", 1, day, 0, staff=1), _loan(11, "Basic", 1, day, 0, staff=2)])
    got = {r.staffid: (r.total_records, r.wps) for r in library.staff_workload(wh).collect()}
    assert got == {1: (1, 0.01), 2: (1, None), 4: (0, None)}   # NULL salary left out


def test_staff_bucket_range_zero_is_qualified(spark):
    day = D(1999, 5, 1)
    wh = _staff_wh(spark, [(1, 1, 100), (2, 2, 100)],
                   [_loan(10, "Basic", 1, day, 0, staff=1), _loan(11, "Basic", 1, day, 0, staff=2)])
    got = {r.category: r.num_staff for r in library.staff_buckets(wh).collect()}
    assert got == {"Qualified60": 2}


def test_staff_bucket_limits(spark):
    day = D(1999, 5, 1)
    # records per salary: 0, 2, 8, 10 with salary 1 -> limits 2 (20 %) and 8 (80 %)
    loans = [_loan(10 + i, "Basic", 1, day, 0, staff=s) for s, n in [(2, 2), (3, 8), (4, 10)]
             for i in range(n)]
    wh = _staff_wh(spark, [(1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 1)], loans)
    got = {r.category: r.num_staff for r in library.staff_buckets(wh).collect()}
    # exactly min + 0.2 * range is not below it; exactly min + 0.8 * range is Top20
    assert got == {"Underperformance20": 1, "Qualified60": 1, "Top20": 2}
    rep = {r.category: r.workload_salary for r in library.staff_report(wh).collect()}
    assert rep["Underperformance20"] is None        # 0 records


def test_limit_zero_members_leave_the_percentage(spark):
    day = D(1999, 5, 3)
    loans = [_loan(1, "Student", 0, day, 0), _loan(2, "Basic", 1, day, 0), _loan(3, "Basic", 1, day, 0),
             _loan(3, "Basic", 1, day, 0)]
    members = spark.createDataFrame([(1, 1, "Student", 0), (2, 2, "Basic", 1), (3, 3, "Basic", 1)],
                                    "member_key long, memberid long, membershiptype string, maxreservation long")
    wh = _staff_wh(spark, [(1, 1, 1)], loans)
    wh.frames["members"] = members
    got = {r.membershiptype: r for r in library.membership_utilisation_month(wh).collect()}
    assert got["Student"].hit_maxbookuti_perc == 0.0 and got["Student"].bookloaninmonths == 1
    assert got["Basic"].hit_maxbookuti_perc == 100.0 and got["Basic"].hit_maxresruti_perc == 0.0


def test_repeat_offender_thresholds(spark):
    day, dob = D(1999, 5, 3), D(1970, 1, 1)
    loans = ([_loan(1, "Basic", 1, day, 5, dob=dob)] * 2                        # 2 loans: never
             + [_loan(2, "Basic", 1, day, 5, dob=dob)] * 2 + [_loan(2, "Basic", 1, day, 0, dob=dob)] * 2
             + [_loan(3, "Basic", 1, day, 5, dob=dob)] + [_loan(3, "Basic", 1, day, 0, dob=dob)] * 2)
    wh = _staff_wh(spark, [(1, 1, 1)], loans)
    r = library.repeat_offenders(wh).collect()
    assert [(x.members_with_activity, x.repeat_offenders) for x in r] == [(3, 1)]  # only member 2 (2/4)


def test_member_with_two_versions_is_not_double_counted(spark):
    """D10: versions of one member must not multiply that member's loans."""
    day, dob = D(1999, 5, 3), D(1970, 1, 1)
    v1 = (1, 7, "Basic", 1, 1, 7, dob, "ASIA", 1, 1, day, 1, 1, 10, 5)        # version key 1
    v2 = (2, 7, "Basic", 1, 1, 7, dob, "ASIA", 1, 1, day, 2, 1, 10, 0)        # version key 2
    wh = _staff_wh(spark, [(1, 1, 1)], [v1, v2])
    rows = library.overdue_member_behaviour(wh).collect()
    assert [(r.total_loans, r.overdue_loans, r.members_with_activity) for r in rows] == [(2, 1, 1)]
