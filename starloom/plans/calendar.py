"""Date dimension, holiday enrichment and academic years.

The calendar is one row per day between two bounds. The bounds come from
the data (1 January of the first order year to 31 December of the last),
so the dimension always covers the facts; ``date_dim_between`` takes
explicit dates instead (the source range 2000-01-01..2025-12-31 gives
9,497 rows). The key is ``100001 + days since the start``: dense and
ordered without any sort or global window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.sources.tables import Warehouse

# First date key, and the length of a stored festive event
DATE_KEY_START = 100001
EVENT_CUT = 25

# Yearly holidays used to enrich the calendar (month, day, event);
# 1 May carries two events, which are merged into one festive_event text.
HOLIDAY_RULES = [
    (1, 1, "New Year's Day"),
    (5, 1, "Labour Day"),
    (5, 1, "Wesak Day"),
    (8, 31, "National Day"),
    (12, 25, "Christmas Day"),
]

# Holidays by region (region, month, day, event); without a region all
# regions keep it. Some regions keep several events on one day.
REGIONAL_RULES = [
    (None, 1, 1, "New Year's Day"),
    (None, 5, 1, "Labour Day"),
    ("ASIA", 5, 1, "Wesak Day"),
    ("ASIA", 8, 31, "National Day"),
    ("AMERICA", 7, 4, "Independence Day"),
    ("EUROPE", 12, 26, "Second Day of Christmas"),
    ("EUROPE", 5, 1, "Spring Day"),
    ("AFRICA", 5, 25, "Africa Day"),
    ("MIDDLE EAST", 3, 21, "New Year"),
]

# The two academic-year windows of the enrollment mart
ACADEMIC_WINDOWS = [
    (dt.date(2025, 6, 16), dt.date(2026, 4, 25), "2025/26"),
    (dt.date(2026, 6, 29), dt.date(2027, 4, 24), "2026/27"),
]


# the same rule on days that the supplied tables have
ACADEMIC_EXAMPLE = [
    (dt.date(1997, 6, 16), dt.date(1998, 4, 25), "1997/98"),
    (dt.date(1998, 6, 29), dt.date(1999, 4, 24), "1998/99"),
]


def calendar_bounds(wh: Warehouse) -> DataFrame:
    """One row (start, end): whole years spanning every day that a fact uses. The plan
    holds the two dates, no scan of the facts."""
    low, high = wh.fact_bounds()
    start, end = (None, None) if low is None else (dt.date(low.year, 1, 1), dt.date(high.year, 12, 31))
    return wh.spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))


def date_dim_from_bounds(bounds: DataFrame) -> DataFrame:
    """The 18-column date dimension for the days of a one-row ``bounds``."""
    days = bounds.select("start", F.explode(F.sequence("start", "end")).alias("cal_date"))
    d = F.col("cal_date")
    dow = F.dayofweek(d)                       # 1 = Sunday ... 7 = Saturday
    year = F.year(d)
    month = F.month(d)
    quarter = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    return days.select(
        (F.datediff(d, F.col("start")) + F.lit(DATE_KEY_START)).cast("bigint").alias("date_key"),
        d.alias("cal_date"),
        F.date_format(d, "yyyy MMMM dd").alias("full_desc"),
        dow.cast("bigint").alias("day_week"),
        F.dayofmonth(d).cast("bigint").alias("day_num_month"),
        F.dayofyear(d).cast("bigint").alias("day_num_year"),
        F.when(d == F.last_day(d), "Y").otherwise("N").alias("last_day_ind"),
        # date + (7 - D) with 1 = Sunday lands on Saturday (the source formula)
        F.date_add(d, (F.lit(7) - dow).cast("int")).alias("cal_week_end_date"),
        F.weekofyear(d).cast("bigint").alias("cal_week_year"),
        F.upper(F.date_format(d, "MMMM")).alias("month_name"),
        month.cast("bigint").alias("cal_month_year"),
        F.date_format(d, "yyyy-MM").alias("cal_year_month"),
        quarter.alias("cal_quarter"),
        F.concat(year.cast("string"), F.lit("-"), quarter).alias("cal_year_quarter"),
        year.cast("bigint").alias("cal_year"),
        F.lit("N").alias("holiday_ind"),
        F.when(dow.between(2, 6), "Y").otherwise("N").alias("weekday_ind"),
        F.lit(None).cast("string").alias("festive_event"),
    )


def date_dim(wh: Warehouse) -> DataFrame:
    """Date dimension covering the order years of the warehouse."""
    return wh.memo("date_dim", lambda: date_dim_from_bounds(calendar_bounds(wh)))


def date_dim_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    return date_dim_from_bounds(spark.range(1).select(F.lit(start).alias("start"),
                                                      F.lit(end).alias("end")))


def holiday_table(dates: DataFrame) -> DataFrame:
    """(holiday_date, festive_event) for every calendar day matching a rule.

    The rules (5 rows) are broadcast and matched on month and day, so the
    table grows with the calendar, not with a hand-written list.
    """
    spark = dates.sparkSession
    rules = spark.createDataFrame(HOLIDAY_RULES, "h_month int, h_day int, festive_event string")
    return (dates.select("cal_date")
            .join(F.broadcast(rules),
                  (F.month("cal_date") == F.col("h_month")) & (F.dayofmonth("cal_date") == F.col("h_day")))
            .select(F.col("cal_date").alias("holiday_date"), "festive_event"))


def apply_holidays(dim: DataFrame, holidays: DataFrame) -> DataFrame:
    """MERGE of a holiday table into the date dimension (every row rewritten).

    Each event is cut to 25 characters; several events on one day are all
    kept, in one text ("a; b", sorted), so the join cannot multiply calendar
    rows; days without an event get holiday_ind 'N' and a NULL event. Days
    outside the calendar are dropped first, so what is broadcast has at most
    the calendar's days.
    """
    days = F.broadcast(dim.select(F.col("cal_date").alias("holiday_date")))
    per_day = (holidays.join(days, "holiday_date", "left_semi").groupBy("holiday_date")
               .agg(F.array_join(F.sort_array(F.collect_set(F.substring("festive_event", 1, EVENT_CUT))), "; ").alias("_ev")))
    j = dim.join(F.broadcast(per_day), dim.cal_date == per_day.holiday_date, "left")
    return (j.withColumn("holiday_ind", F.when(F.col("_ev").isNotNull(), "Y").otherwise("N"))
            .withColumn("festive_event", F.col("_ev"))
            .select(*dim.columns))


def regional_holidays(days: DataFrame, events: DataFrame) -> DataFrame:
    """Bridge of days and regions: (cal_date, region, festive_event), one row for each
    event that a region keeps on a day. ``events`` has a region (NULL: all regions keep
    it), month, day and event; regions come from it. Equal events count once, days that the
    calendar lacks drop out. Its size is bounded by the calendar and the rules."""
    # every region keeps the common events: a row each
    regions = events.agg(F.collect_set("region")).scalar()
    kept = events.withColumn("region", F.explode(F.when(F.col("region").isNull(), regions).otherwise(F.array("region"))))
    return (days.select("cal_date").join(F.broadcast(kept), (F.month("cal_date") == F.col("h_month")) & (F.dayofmonth("cal_date") == F.col("h_day")))
            .select("cal_date", "region", F.substring("festive_event", 1, EVENT_CUT).alias("festive_event")).distinct())


def date_dim_holidays(wh: Warehouse) -> DataFrame:
    dim = date_dim(wh)
    return apply_holidays(dim, holiday_table(dim))


def mark_holiday(dim: DataFrame, day: dt.date, event: str = "NEW YEAR") -> DataFrame:
    """Mark one day as a holiday, leaving every other row as it is."""
    hit = F.col("cal_date") == F.lit(day)
    return (dim.withColumn("holiday_ind", F.when(hit, "Y").otherwise(F.col("holiday_ind")))
            .withColumn("festive_event", F.when(hit, F.lit(event)).otherwise(F.col("festive_event"))))


def academic_year(dim: DataFrame, windows=None, column: str = "acad_year") -> DataFrame:
    """``UPDATE ... SET acad_year = CASE WHEN cal_date BETWEEN .. THEN label ...
    ELSE acad_year END`` for explicit windows (default: the source's two)."""
    windows = ACADEMIC_WINDOWS if windows is None else windows
    cur = F.col(column) if column in dim.columns else F.lit(None).cast("string")
    expr = cur
    for start, end, label in reversed(windows):
        expr = F.when(F.col("cal_date").between(F.lit(start), F.lit(end)), F.lit(label)).otherwise(expr)
    return dim.withColumn(column, expr)


def academic_year_rule(dim: DataFrame, start_md=(6, 16), end_md=(4, 25),  # the 2025/26 dates
                       column: str = "acad_year") -> DataFrame:
    """Academic year from a yearly rule: a year runs from ``start_md`` to
    ``end_md`` of the next year and is labelled 'YYYY/YY'; days in the break
    keep their current value."""
    d = F.col("cal_date")
    md = F.month(d) * 100 + F.dayofmonth(d)
    sy = F.when(md >= start_md[0] * 100 + start_md[1], F.year(d)).otherwise(F.year(d) - 1)
    in_term = d <= F.make_date(sy + 1, F.lit(end_md[0]), F.lit(end_md[1]))
    label = F.concat(sy.cast("string"), F.lit("/"), F.lpad(((sy + 1) % 100).cast("string"), 2, "0"))
    cur = F.col(column) if column in dim.columns else F.lit(None).cast("string")
    return dim.withColumn(column, F.when(in_term, label).otherwise(cur))
