"""Library reports: membership utilisation, overdue behaviour, staff workload.

All reports read loans / reservations of a report window; the window is
pushed into the lineitem / orders scans. Member attributes travel with the
loans (one member join), so no report joins the member dimension twice.
Per-member and per-staff figures are computed by ordinary grouped
aggregates (map-side partial aggregation first), then rolled up; scalar
statistics (overall rates, min / max of a ratio, month counts) are scalar
subqueries evaluated once, never a cross join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import (age_band, age_years, avg_round, pct_round, round_ratio,
                                       scalar_row, year_month)
from starloom.operators.keys import materialize
from starloom.plans.calendar import (REGIONAL_RULES, academic_year_rule, apply_holidays, date_dim_between, holiday_table,
                                     regional_holidays)
from starloom.sources.tables import REFERENCE_DATE, REPORT_END, REPORT_START, Warehouse

# Display order of the membership types
TYPE_ORDER = ["BASIC", "STANDARD", "PREMIUM", "STUDENT", "INSTITUTIONAL"]
# Staff buckets in display order, and the shares of the
# records-per-salary range that separate them
BUCKET_ORDER = ["Top20", "Qualified60", "Underperformance20"]
TOP_SHARE, BOTTOM_SHARE = 0.8, 0.2
# A repeat offender has at least this many loans, at least
# this share of them overdue
REPEAT_MIN_LOANS, REPEAT_MIN_SHARE_NUM, REPEAT_MIN_SHARE_DEN = 3, 1, 2

def _overdue():
    """1 for an overdue loan (NULL overdue days count as 0), else 0."""
    return (F.coalesce(F.col("overduedays"), F.lit(0)) > 0).cast("bigint")


def _type_rank(col: str = "membershiptype"):
    expr = F.lit(99)
    for i, t in reversed(list(enumerate(TYPE_ORDER, start=1))):
        expr = F.when(F.upper(F.col(col)) == t, F.lit(i)).otherwise(expr)
    return expr


def _is_repeat():
    """1 for a repeat offender (per-member loans_all / loans_overdue), else 0."""
    return ((F.col("loans_all") >= REPEAT_MIN_LOANS)
            & (F.col("loans_overdue") * REPEAT_MIN_SHARE_DEN
               >= F.col("loans_all") * REPEAT_MIN_SHARE_NUM)).cast("bigint")


def _loan_stats(g):
    """Aggregates shared by the overdue reports (apply to a grouped frame)."""
    return g.agg(F.count(F.lit(1)).alias("total_loans"),
                 F.sum(_overdue()).alias("overdue_loans"),
                 F.sum(F.coalesce("overduedays", F.lit(0))).alias("_od_days"))


def _overdue_cols(keys):
    return [*keys, F.col("total_loans").cast("bigint"), F.col("overdue_loans").cast("bigint"),
            pct_round("overdue_loans", "total_loans").alias("overdue_rate_pct"),
            avg_round("_od_days", "total_loans").alias("avg_overdue_days")]


def loans(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    return wh.book_loans(start, end).withColumn("year_month", year_month("loan_date"))


# ------------------------------------------------------------------ A12
def membership_utilisation_month(wh: Warehouse, start=REPORT_START, end=REPORT_END,
                                 ordered: bool = True) -> DataFrame:
    """Per (membership type, month): loans, average loan days, % of active
    members reaching their loan limit, % reaching their reservation limit
    (successful reservations), overdue loans, average overdue days.
    Members whose limit is 0 count in neither part of a %; months with
    reservations but no loans do not appear (loans drive the rows)."""
    l = loans(wh, start, end)
    per_member = (l.groupBy("membershiptype", "year_month", "memberid", "maxbookloan")
                  .agg(F.count(F.lit(1)).alias("n"),
                       F.sum(F.coalesce("loandays", F.lit(0))).alias("days"),
                       F.sum(_overdue()).alias("od"),
                       F.sum(F.coalesce("overduedays", F.lit(0))).alias("od_days")))
    limited = F.col("maxbookloan") > 0
    loans_m = per_member.groupBy("membershiptype", "year_month").agg(
        F.sum("n").alias("n"), F.sum("days").alias("days"), F.sum("od").alias("od"),
        F.sum("od_days").alias("od_days"),
        F.count_distinct(F.when(limited, F.col("memberid"))).alias("b_den"),
        F.count_distinct(F.when(limited & (F.col("n") >= F.col("maxbookloan")), F.col("memberid"))).alias("b_hit"))

    m = wh.members().select("member_key", "memberid", "membershiptype", "maxreservation")
    r = (wh.reservations(start, end).filter(F.upper("reservationstatus") == "SUCCESS")
         .select("member_key", year_month("resv_date").alias("year_month")))
    # keys first (few rows per member), then members: versions of one member add up
    r_member = (r.groupBy("member_key", "year_month").agg(F.count(F.lit(1)).alias("n"))
                .join(m, "member_key")
                .groupBy("membershiptype", "year_month", "memberid", "maxreservation").agg(F.sum("n").alias("n")))
    r_limited = F.col("maxreservation") > 0
    resv_m = r_member.groupBy("membershiptype", "year_month").agg(
        F.count_distinct(F.when(r_limited, F.col("memberid"))).alias("r_den"),
        F.count_distinct(F.when(r_limited & (F.col("n") >= F.col("maxreservation")), F.col("memberid"))).alias("r_hit"))

    out = (loans_m.join(resv_m, ["membershiptype", "year_month"], "left")
           .select("membershiptype", "year_month",
                   F.col("n").cast("bigint").alias("bookloaninmonths"),
                   avg_round("days", "n").alias("avgloandurationdays"),
                   F.coalesce(pct_round("b_hit", "b_den"), F.lit(0.0)).alias("hit_maxbookuti_perc"),
                   F.coalesce(pct_round("r_hit", "r_den"), F.lit(0.0)).alias("hit_maxresruti_perc"),
                   F.col("od").cast("bigint").alias("totaloverdue"),
                   avg_round("od_days", "n").alias("avgoverduedays")))
    if ordered:
        out = out.orderBy(_type_rank(), "membershiptype", "year_month")
    return out


# ------------------------------------------------------------------ A13
def overdue_month(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    return (_loan_stats(loans(wh, start, end).groupBy("year_month"))
            .select(*_overdue_cols(["year_month"])).orderBy("year_month"))


# ---------------------------------------------------------------- A14/15
def _banded_members(wh: Warehouse, start, end, ref: dt.date) -> DataFrame:
    """One row per active member: band, type, loans, overdue loans, overdue days."""
    l = loans(wh, start, end)
    per = (l.groupBy("memberid", "membershiptype", "dob")
           .agg(F.count(F.lit(1)).alias("loans_all"), F.sum(_overdue()).alias("loans_overdue"),
                F.sum(F.coalesce("overduedays", F.lit(0))).alias("od_days")))
    return per.withColumn("age_band", age_band(age_years(ref, F.col("dob"))))


def repeat_offenders(wh: Warehouse, start=REPORT_START, end=REPORT_END,
                     ref: dt.date = REFERENCE_DATE) -> DataFrame:
    """Members with at least 3 loans and an overdue share of at least one
    half, per age band and type."""
    per = _banded_members(wh, start, end, ref)
    is_rep = _is_repeat()
    g = per.groupBy("age_band", "membershiptype").agg(
        F.count(F.lit(1)).alias("members_with_activity"), F.sum(is_rep).alias("repeat_offenders"))
    return g.select("age_band", "membershiptype",
                    F.col("members_with_activity").cast("bigint"),
                    F.col("repeat_offenders").cast("bigint"),
                    pct_round("repeat_offenders", "members_with_activity").alias("repeat_offender_rate_pct"))


def overdue_member_behaviour(wh: Warehouse, start=REPORT_START, end=REPORT_END,
                             ref: dt.date = REFERENCE_DATE, ordered: bool = True) -> DataFrame:
    """Overdue figures per age band and type, with the repeat-offender
    figures of the same group. Both come from one per-member aggregate (a
    member has one band and type), so the band/type grid is joined once."""
    per = _banded_members(wh, start, end, ref)
    is_rep = _is_repeat()
    g = per.groupBy("age_band", "membershiptype").agg(
        F.sum("loans_all").alias("total_loans"), F.sum("loans_overdue").alias("overdue_loans"),
        F.sum("od_days").alias("_od_days"),
        F.count(F.lit(1)).alias("members_with_activity"), F.sum(is_rep).alias("repeat_offenders"))
    out = g.select(*_overdue_cols(["age_band", "membershiptype"]),
                   F.col("members_with_activity").cast("bigint"),
                   F.col("repeat_offenders").cast("bigint"),
                   F.coalesce(pct_round("repeat_offenders", "members_with_activity"), F.lit(0.0))
                   .alias("repeat_offender_rate_pct"))
    if ordered:
        out = out.orderBy(F.desc("overdue_rate_pct"), F.desc("repeat_offenders"),
                          F.desc("repeat_offender_rate_pct"), "age_band", "membershiptype")
    return out


# ---------------------------------------------------------------- A16-18
def _staff_records(wh: Warehouse, start, end) -> DataFrame:
    """(staff_key, loans, resvs) pre-aggregated per fact before any join."""
    lo = wh.staff_loans(start, end).groupBy("staff_key").agg(F.count(F.lit(1)).alias("loans"))
    rs = wh.reservations(start, end).groupBy("staff_key").agg(F.count(F.lit(1)).alias("resvs"))
    return lo.join(rs, "staff_key", "full_outer")


def _staff_base(wh: Warehouse, start, end) -> DataFrame:
    s = wh.staff().filter(F.col("salary").isNotNull())
    rec = _staff_records(wh, start, end)
    j = s.join(rec, "staff_key", "left")
    total = (F.coalesce("loans", F.lit(0)) + F.coalesce("resvs", F.lit(0))).cast("bigint")
    return j.select("staffid", "salary", total.alias("total_records"),
                    F.when(F.col("salary") > 0, total.cast("double") / F.col("salary").cast("double"))
                    .alias("wps"))


def staff_workload(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Per staff with a salary: records (loans + reservations) and records
    per salary unit (NULL when the salary is not positive)."""
    return _staff_base(wh, start, end).withColumn("salary", F.col("salary").cast("double"))


def _bucket_agg(wh: Warehouse, start, end) -> DataFrame:
    # one row per staff member, read by the range statistics and the buckets:
    # written once so the loan and reservation joins run only once
    base = materialize(_staff_base(wh, start, end).withColumn("wps", F.coalesce("wps", F.lit(0.0))),
                       "staff-base")
    lo, hi = F.min("wps"), F.max("wps")
    top, middle, bottom = BUCKET_ORDER
    st = scalar_row(base, rng=hi - lo, top=lo + F.lit(TOP_SHARE) * (hi - lo),
                    bottom=lo + F.lit(BOTTOM_SHARE) * (hi - lo))
    cat = (F.when(st["rng"] == 0, middle)
           .when(F.col("wps") >= st["top"], top)
           .when(F.col("wps") < st["bottom"], bottom)
           .otherwise(middle))
    return (base.withColumn("category", cat).groupBy("category")
            .agg(F.sum("total_records").cast("bigint").alias("total_records"),
                 F.count(F.lit(1)).cast("bigint").alias("num_staff"),
                 F.sum(F.coalesce("salary", F.lit(0))).alias("_salary")))


def staff_buckets(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Staff grouped by where their records-per-salary sits in the min..max
    range: top 20 % of the range, bottom 20 %, or the middle (also when
    the range is 0)."""
    return _bucket_agg(wh, start, end).select(
        "category", "total_records", "num_staff", F.col("_salary").cast("double").alias("total_salary"))


def staff_report(wh: Warehouse, start=REPORT_START, end=REPORT_END, ordered: bool = True) -> DataFrame:
    """Buckets with salary per record ("Workload/Salary")."""
    b = _bucket_agg(wh, start, end)
    cents = (F.col("_salary") * 100).cast("bigint")
    out = b.select("category", F.col("total_records").alias("number_of_records"),
                   F.col("num_staff").alias("number_of_staff"),
                   F.col("_salary").cast("double").alias("total_salary_expenses"),
                   # salary / records rounded to cents: cents / (records * 100)
                   round_ratio(cents, F.col("total_records") * 100).alias("workload_salary"))
    if ordered:
        rank = F.lit(99)
        for i, c in reversed(list(enumerate(BUCKET_ORDER, start=1))):
            rank = F.when(F.col("category") == c, F.lit(i)).otherwise(rank)
        out = out.orderBy(rank)
    return out


# ------------------------------------------------------------- B10 / B20
def _period_col(period: str):
    d = F.col("loan_date")
    if period == "month":
        return year_month(d)
    if period == "quarter":
        return F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))
    if period == "year":
        return F.year(d).cast("string")
    raise ValueError(period)


def overdue_by_period(wh: Warehouse, period: str = "quarter", by_type: bool = True,
                      start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Overdue rate by a calendar period (month, quarter, year, holiday flag,
    academic year, event), optionally per membership type. Under "event" the
    loans of a day count for each event of that day."""
    l = loans(wh, start, end)
    if period == "event":
        # a few events a year, on the days of the window
        days = holiday_table(date_dim_between(wh.spark, start, end)).select(F.col("holiday_date").alias("loan_date"), F.col("festive_event").alias("period"))
        l = l.join(F.broadcast(days.distinct()), "loan_date")
    elif period in ("holiday", "academic_year"):
        days = date_dim_between(wh.spark, start, end)
        cal = apply_holidays(days, holiday_table(days))
        if period == "academic_year":
            cal = academic_year_rule(cal)
        col = "holiday_ind" if period == "holiday" else "acad_year"
        # calendar days of the window: bounded, broadcast
        l = l.join(F.broadcast(cal.select(F.col("cal_date").alias("loan_date"),
                                          F.col(col).alias("period"))), "loan_date", "left")
    else:
        l = l.withColumn("period", _period_col(period))
    keys = ["period"] + (["membershiptype"] if by_type else [])
    return _loan_stats(l.groupBy(*keys)).select(*_overdue_cols(keys))


def overdue_by_regional_holiday(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Overdue rate per region, on its own holidays and on other days. The bridge has a row
    for each event of a day, so it only says whether there is one: a loan counts once."""
    days = date_dim_between(wh.spark, start, end)
    events = wh.spark.createDataFrame(REGIONAL_RULES, "region string, h_month int, h_day int, festive_event string")
    kept = regional_holidays(days, events).select(F.col("cal_date").alias("loan_date"), "region", F.lit("Y").alias("_kept")).distinct()
    l = loans(wh, start, end).join(F.broadcast(kept), ["loan_date", "region"], "left")  # days of the window, few regions
    l = l.withColumn("region", F.coalesce("region", F.lit("Unknown"))).withColumn("holiday", F.coalesce("_kept", F.lit("N")))
    return _loan_stats(l.groupBy("region", "holiday")).select(*_overdue_cols(["region", "holiday"]))


def overdue_by_regional_event(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Overdue rate per region and event: a loan counts for each event of its region's day."""
    days = date_dim_between(wh.spark, start, end)
    events = wh.spark.createDataFrame(REGIONAL_RULES, "region string, h_month int, h_day int, festive_event string")
    kept = regional_holidays(days, events).withColumnRenamed("cal_date", "loan_date")
    l = loans(wh, start, end).join(F.broadcast(kept), ["loan_date", "region"])
    return _loan_stats(l.groupBy("region", "festive_event")).select(*_overdue_cols(["region", "festive_event"]))


def overdue_peak(wh: Warehouse, period: str = "month", start=REPORT_START, end=REPORT_END) -> DataFrame:
    """The period with the highest overdue rate (ties: more overdue loans,
    then the earlier period)."""
    return (overdue_by_period(wh, period, False, start, end)
            .orderBy(F.desc("overdue_rate_pct"), F.desc("overdue_loans"), F.asc("period")).limit(1))


# ---------------------------------------------------------------- B11-13
def _resv_member_months(wh: Warehouse, start, end) -> DataFrame:
    """Successful reservations per member and month, with the member's limit."""
    m = wh.members().select("member_key", "memberid", "membershiptype", "maxreservation")
    return (wh.reservations(start, end).filter(F.upper("reservationstatus") == "SUCCESS")
            .groupBy("member_key", year_month("resv_date").alias("year_month"))
            .agg(F.count(F.lit(1)).alias("n")).join(m, "member_key")
            .groupBy("membershiptype", "memberid", "year_month", "maxreservation").agg(F.sum("n").alias("n")))


def avg_utilisation(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Per type: average monthly loans per active member-month against the
    average loan limit of these member-months, and the same for successful
    reservations."""
    l = loans(wh, start, end)
    lm = (l.groupBy("membershiptype", "memberid", "year_month", "maxbookloan")
          .agg(F.count(F.lit(1)).alias("n"))
          .groupBy("membershiptype")
          .agg(F.count(F.lit(1)).alias("loan_member_months"), F.sum("n").alias("loans"),
               F.sum("maxbookloan").alias("loan_limits")))
    r = (_resv_member_months(wh, start, end)
         .groupBy("membershiptype")
         .agg(F.count(F.lit(1)).alias("resv_member_months"), F.sum("n").alias("resvs"),
              F.sum("maxreservation").alias("resv_limits")))
    j = lm.join(r, "membershiptype", "full_outer")
    return j.select(
        "membershiptype",
        F.coalesce("loan_member_months", F.lit(0)).cast("bigint").alias("loan_member_months"),
        avg_round("loans", "loan_member_months").alias("avg_monthly_loans"),
        avg_round("loan_limits", "loan_member_months").alias("avg_loan_limit"),
        pct_round("loans", "loan_limits").alias("loan_utilisation_pct"),
        F.coalesce("resv_member_months", F.lit(0)).cast("bigint").alias("resv_member_months"),
        avg_round("resvs", "resv_member_months").alias("avg_monthly_resvs"),
        avg_round("resv_limits", "resv_member_months").alias("avg_resv_limit"),
        pct_round("resvs", "resv_limits").alias("resv_utilisation_pct"))


def high_utilisation_members(wh: Warehouse, threshold_pct: int = 90,
                             start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Per type and kind (loan, reservation): member-months (and members)
    whose monthly loans or successful reservations exceed ``threshold_pct`` %
    of the limit."""
    lo = (loans(wh, start, end).groupBy("membershiptype", "memberid", "year_month", F.col("maxbookloan").alias("most"))
          .agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit("loan")))
    rs = (_resv_member_months(wh, start, end).withColumnRenamed("maxreservation", "most")
          .withColumn("kind", F.lit("reservation")))
    mm = lo.unionByName(rs).filter((F.col("most") > 0) & (F.col("n") * 100 > F.col("most") * threshold_pct))
    return mm.groupBy("membershiptype", "kind").agg(
        F.count(F.lit(1)).cast("bigint").alias("member_months_over"),
        F.countDistinct("memberid").cast("bigint").alias("members_over"))


def overdue_above_average(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Types whose overdue rate is above the overall rate (compared exactly
    as cross-multiplied integers)."""
    l = loans(wh, start, end)
    per = materialize(_loan_stats(l.groupBy("membershiptype")), "type-overdue")  # one row per type
    tot = scalar_row(per, loans=F.sum("total_loans"), over=F.sum("overdue_loans"),
                     rate=pct_round(F.sum("overdue_loans"), F.sum("total_loans")))
    return (per.filter(F.col("overdue_loans") * tot["loans"] > tot["over"] * F.col("total_loans"))
            .select(*_overdue_cols(["membershiptype"]), tot["rate"].alias("overall_rate_pct")))


# ---------------------------------------------------------------- B14/15/21
def overdue_by_region(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    return _loan_stats(loans(wh, start, end).groupBy("region")).select(*_overdue_cols(["region"]))


def overdue_by_category(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Overdue figures per book category: loans are first reduced to one row
    per title, then joined to the titles."""
    per_title = _loan_stats(loans(wh, start, end).groupBy("booktitle_key"))
    t = wh.book_titles()
    g = per_title.join(t, "booktitle_key").groupBy("category").agg(
        F.sum("total_loans").alias("total_loans"), F.sum("overdue_loans").alias("overdue_loans"),
        F.sum("_od_days").alias("_od_days"))
    return g.select(*_overdue_cols(["category"]))


def duration_vs_overdue(wh: Warehouse, start=REPORT_START, end=REPORT_END, period: str = "quarter") -> DataFrame:
    """Per type and month, quarter or year: the loan-duration limit against overdue days."""
    l = loans(wh, start, end).withColumn("period", _period_col(period))
    g = l.groupBy("membershiptype", "period").agg(
        F.count(F.lit(1)).alias("total_loans"), F.sum(_overdue()).alias("overdue_loans"),
        F.sum(F.coalesce("overduedays", F.lit(0))).alias("_od_days"),
        F.sum("loanduration").alias("_dur"))
    return g.select(*_overdue_cols(["membershiptype", "period"]),
                    avg_round("_dur", "total_loans").alias("avg_loan_duration"))


# ---------------------------------------------------------------- B16-19, B22
def _months_in(start: dt.date, end: dt.date) -> int:
    return (end.year - start.year) * 12 + end.month - start.month + 1


def staff_month_average(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Average records per month per staff over every month of the window
    (months without records count as 0, so the divisor is the month count;
    no staff x month grid is materialised)."""
    n_months = _months_in(start, end)
    s = wh.staff().select("staff_key", "staffid")
    rec = _staff_records(wh, start, end)
    total = (F.coalesce("loans", F.lit(0)) + F.coalesce("resvs", F.lit(0))).cast("bigint")
    return (s.join(rec, "staff_key", "left")
            .select("staffid", total.alias("total_records"),
                    avg_round(total, F.lit(n_months)).alias("avg_monthly_records")))


def _staff_month_records(wh: Warehouse, start, end) -> DataFrame:
    lo = wh.staff_loans(start, end).select("staff_key", year_month("loan_date").alias("year_month"))
    rs = wh.reservations(start, end).select("staff_key", year_month("resv_date").alias("year_month"))
    return lo.unionByName(rs).groupBy("staff_key", "year_month").agg(F.count(F.lit(1)).alias("n"))


def staff_underperforming(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Staff below the month's average (records / staff) in more than half
    of the window's months; a month without records is below whenever the
    month had any record."""
    n_months = _months_in(start, end)
    s = wh.staff().select("staff_key", "staffid")
    n_staff = s.agg(F.count(F.lit(1))).scalar()
    # the staff x month counts feed a scalar statistic and the main plan:
    # write them once so the loan and reservation joins run only once
    sm = materialize(_staff_month_records(wh, start, end), "staff-months")
    month_tot = sm.groupBy("year_month").agg(F.sum("n").alias("tot"))   # one row per month
    m_pos = month_tot.agg(F.count(F.when(F.col("tot") > 0, F.lit(1)))).scalar()
    per = (sm.join(F.broadcast(month_tot), "year_month")
           .groupBy("staff_key")
           .agg(F.count(F.lit(1)).alias("active"),
                F.count(F.when(F.col("n") * n_staff < F.col("tot"), F.lit(1))).alias("below_active")))
    j = s.join(per, "staff_key", "left")
    below = (F.coalesce("below_active", F.lit(0)) + m_pos - F.coalesce("active", F.lit(0))).cast("bigint")
    return (j.select("staffid", below.alias("months_below"), F.lit(n_months).cast("bigint").alias("n_months"))
            .filter(F.col("months_below") * 2 > F.col("n_months")))


def staff_top3(wh: Warehouse, start=REPORT_START, end=REPORT_END, k: int = 3) -> DataFrame:
    return (staff_month_average(wh, start, end).select("staffid", "total_records")
            .orderBy(F.desc("total_records"), F.asc("staffid")).limit(k))


def reservation_processing(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Per status: average days from reserving to ready, from ready to
    success and in total; a duration that a reservation lacks is left out."""
    spans = {"reservetoreadydays": "avg_reserve_to_ready_days", "readytosuccessdays": "avg_ready_to_success_days",
             "totaldays": "avg_total_days"}
    g = wh.reservations(start, end).groupBy("reservationstatus").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in spans], *[F.count(c).alias(f"n_{c}") for c in spans])
    return g.select("reservationstatus", F.col("n").cast("bigint").alias("n_reservations"),
                    *[avg_round(c, f"n_{c}").alias(name) for c, name in spans.items()])


def staff_member_interactions(wh: Warehouse, start=REPORT_START, end=REPORT_END) -> DataFrame:
    """Distinct members served per staff over loans and reservations."""
    lo = wh.loan_keys(start, end)
    rs = wh.reservations(start, end).select("staff_key", "member_key")
    pairs = lo.unionByName(rs).distinct()
    ids = (pairs.join(wh.members().select("member_key", "memberid"), "member_key")
           .join(wh.staff().select("staff_key", "staffid"), "staff_key").select("staffid", "memberid").distinct())
    return ids.groupBy("staffid").agg(F.count("memberid").cast("bigint").alias("n_members"))
