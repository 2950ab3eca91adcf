"""The registered queries: one entry per operator / report key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starloom.operators import dedup, gate, islands, quality, scd2
from starloom.operators.keys import surrogate_key
from starloom.operators.scan import scan
from starloom.operators.store import materialize
from starloom.plans import build, calendar, dims, facts, generate, library, retail, rollup
from starloom.functions.scalar import net_amount
from starloom.registry import register
from starloom.sources.tables import PAST_QUARTER_START, PAST_YEAR_START, REPORT_END


# ----------------------------------------------------------------- retail
@register("customers_over_threshold")
def _q(wh):
    return retail.customers_over_threshold(wh, 1995, 1000)


@register("customers_over_threshold_by_year")
def _q(wh):  # noqa: F811
    return retail.customers_over_threshold_by_year(wh, 1000)


@register("best_category")
def _q(wh):  # noqa: F811
    return retail.best_categories(wh, 1)


@register("top3_categories")
def _q(wh):  # noqa: F811
    return retail.best_categories(wh, 3)


@register("top_shipper")
def _q(wh):  # noqa: F811
    return retail.top_shipper(wh)


@register("lapsed_customers")
def _q(wh):  # noqa: F811
    return retail.lapsed_customers(wh, 1995)


@register("orders_by_country_quarter")
def _q(wh):  # noqa: F811
    return retail.orders_by_country_quarter(wh, 1998)


@register("orders_quarter_pivot")
def _q(wh):  # noqa: F811
    return retail.orders_quarter_pivot(wh, 1998)


@register("revenue_month_pivot")
def _q(wh):  # noqa: F811
    return retail.revenue_month_pivot(wh, (1996, 1998), (1, 6))


@register("dates_of_year")
def _q(wh):  # noqa: F811
    return retail.dates_of_year(wh, 1998)


@register("missing_region")
def _q(wh):  # noqa: F811
    return retail.missing_region(wh)


@register("revenue_by_country")
def _q(wh):  # noqa: F811
    return retail.revenue_by_country(wh)


@register("revenue_by_country_year")
def _q(wh):  # noqa: F811
    return retail.revenue_by_country_year(wh, 1998)


@register("revenue_q1_compare")
def _q(wh):  # noqa: F811
    return retail.revenue_q1_compare(wh, 1997, 1998)


@register("orders_q1_by_country")
def _q(wh):  # noqa: F811
    return retail.orders_q1_by_country(wh, 1998)


@register("date_parts")
def _q(wh):  # noqa: F811
    return retail.date_parts(wh)


@register("active_customers")
def _q(wh):  # noqa: F811
    return retail.active_customers(wh)


@register("order_frequency")
def _q(wh):  # noqa: F811
    return retail.order_frequency(wh)


@register("order_frequency_histogram")
def _q(wh):  # noqa: F811
    return retail.order_frequency_histogram(wh)


@register("unpopular_products")
def _q(wh):  # noqa: F811
    return retail.unpopular_products(wh)


@register("random_customers")
def _q(wh):  # noqa: F811
    return retail.random_customers(wh, 100)


# --------------------------------------------------------------- calendar
@register("date_dim")
def _q(wh):  # noqa: F811
    return calendar.date_dim(wh)


@register("date_dim_holidays")
def _q(wh):  # noqa: F811
    return calendar.date_dim_holidays(wh)


@register("mark_holiday")
def _q(wh):  # noqa: F811
    return calendar.mark_holiday(calendar.date_dim(wh), dt.date(2001, 1, 1))


@register("academic_year")
def _q(wh):  # noqa: F811
    return calendar.academic_year_rule(calendar.date_dim(wh)).select(
        "date_key", "cal_date", "acad_year")


# ------------------------------------------------------- keys and quality
@register("surrogate_key")
def _q(wh):  # noqa: F811
    """Record numbers of the order lines: dense from 1 in the natural order."""
    lines = wh.order_lines().select(*wh.line_order)
    # record number plus the leading order columns (order, product, supplier, line no.)
    return surrogate_key(lines, wh.line_order, "rec_no", 1).select("rec_no", *wh.line_order[:4])


@register("rekey_customers")
def _q(wh):  # noqa: F811
    """New ids from 100001 in customer-id order; name cut to 18 characters
    plus '-' plus the new id."""
    k = surrogate_key(wh.customers(), ["customerid"], "new_customerid", generate.NEW_ID_START)
    return k.select(
        "new_customerid",
        F.concat_ws("", F.substring("companyname", 1, generate.NAME_CUT), F.lit("-"),
                    F.col("new_customerid").cast("string")).alias("companyname"),
        "city", "region", "postalcode", "country")


@register("key_map")
def _q(wh):  # noqa: F811
    """Customer keys over two loads: those with an order up to June 1995, then all."""
    return dims.customer_keys_over_loads(wh, dt.date(1995, 6, 30))


@register("load_gate")
def _q(wh):  # noqa: F811
    """All lines as one batch against a table that holds those of the orders up to 1995, with
    the orders up to 2000 as parents: the rules that each line breaks."""
    order = wh.line_order
    day = F.col("orderdate")
    lines = wh.order_lines().select(*dict.fromkeys([*order, "quantity", "discount"])).join(wh.orders().select("orderid", "orderdate"), "orderid")
    target = lines.where(day <= F.lit(dt.date(1995, 12, 31))).select("orderid", "productid")
    marks = gate.marked(lines, checks={"quantity": F.col("quantity") <= 48, "discount": F.col("discount") > 0}, required=["orderdate"],
                        key=["orderid", "productid"], target=target, first_by=order,
                        parents={"order": (wh.orders(end=dt.date(2000, 12, 31)), ["orderid"], ["orderid"])})
    return marks.select(*order[:4], F.array_join(gate.BROKEN, ", ").alias("broken_rules"))


@register("pk_violations")
def _q(wh):  # noqa: F811
    return quality.pk_violations(wh.order_details(), ["orderid", "productid"])


@register("fk_violations")
def _q(wh):  # noqa: F811
    return quality.fk_violations(wh.orders(), wh.customers(), "customerid").select(
        "orderid", "customerid")


@register("orders_without_lines")
def _q(wh):  # noqa: F811
    """The other way round, which real data break: orders that no line refers to."""
    return quality.fk_violations(wh.orders(), wh.order_details(), "orderid").select("orderid", "customerid")


@register("null_violations")
def _q(wh):  # noqa: F811
    return quality.null_violations(wh.customers(), ["customerid", "companyname", "country",
                                                    "region", "city", "postalcode"])


@register("length_violations")
def _q(wh):  # noqa: F811
    # Declared lengths of the product dimension's text columns
    limits = {"productname": 40, "quantityperunit": 20, "categoryname": 15,
              "sup_companyname": 40, "sup_country": 15, "sup_city": 15}
    p = wh.products()
    s = wh.suppliers().select(F.col("supplierid"), F.col("companyname").alias("sup_companyname"),
                              F.col("country").alias("sup_country"),
                              F.col("city").alias("sup_city"))
    return quality.length_violations(p.join(s, "supplierid", "left"), limits)


@register("key_coverage")
def _q(wh):  # noqa: F811
    return quality.key_coverage(wh.orders(), "customerid")


@register("key_islands")
def _q(wh):  # noqa: F811
    """Runs of contiguous customer ids among those that have ordered."""
    return islands.key_islands(wh.orders(), "customerid")


@register("active_customer_draws")
def _q(wh):  # noqa: F811
    return retail.active_customer_draws(wh)


@register("rewrite_partitions")
def _q(wh):  # noqa: F811
    return build.orders_after_changes(wh)


# ------------------------------------------------------------ dimensions
@register("clean_customers")
def _q(wh):  # noqa: F811
    return dims.clean_customers(wh.customers())


@register("customer_dim")
def _q(wh):  # noqa: F811
    return dims.customer_dim(wh)


@register("employee_dim")
def _q(wh):  # noqa: F811
    return dims.employee_dim(wh)


@register("product_dim")
def _q(wh):  # noqa: F811
    return dims.product_dim(wh)


# ------------------------------------------------------- de-duplication
def _lines_with_rec(wh, *more):
    """Numbered lines: rec_no, the pair and ``more``. They are stored, since the numbering
    (a sort of all lines) would run again for each read of them."""
    order = wh.line_order
    lines = wh.order_lines()
    cols = order + [c for c in ("quantity", "l_discount", "discount")
                    if c not in order and c in lines.columns]
    return materialize(surrogate_key(lines.select(*cols), order, "rec_no", 1).select("rec_no", *dedup.PAIR, *more), "numbered-lines")


@register("running_totals")
def _q(wh):  # noqa: F811
    """Quantity and amount of all lines up to each, in the natural order."""
    order = wh.line_order
    lines = wh.order_lines().withColumn("_net", net_amount("gross", "discount"))
    run = scan(lines, [], order, number="rec_no", sums={"total_quantity": "quantity", "total_net": "_net"})
    return run.select("rec_no", *order[:4], "total_quantity", F.col("total_net").cast("double").alias("total_net"))


@register("previous_line")
def _q(wh):  # noqa: F811
    """The source's sorted cursor: each line beside the one before it, and whether it
    repeats that one's order and product."""
    order = wh.line_order
    run = scan(wh.order_lines().select(*order), [], order, number="rec_no", previous={"prev_orderid": "orderid", "prev_productid": "productid"})
    same = (F.col("orderid") == F.col("prev_orderid")) & (F.col("productid") == F.col("prev_productid"))
    return run.select("rec_no", *order[:4], "prev_orderid", "prev_productid", F.when(same, "Y").otherwise("N").alias("repeated"))


@register("customer_running_spend")
def _q(wh):  # noqa: F811
    """Each customer's orders in time: number, running amount, days since the one before."""
    net = wh.order_details().groupBy("orderid").agg(F.sum("net").alias("net"))
    o = wh.orders().select("orderid", "customerid", "orderdate").join(net, "orderid")
    run = scan(o, ["customerid"], ["orderdate", "orderid"], number="order_no", sums={"spent": "net"}, previous={"before": "orderdate"})
    return run.select("customerid", "orderid", "orderdate", "order_no", F.col("spent").cast("double").alias("spent"),
                      F.datediff("orderdate", "before").cast("bigint").alias("days_since"))


@register("orders_with_duplicates")
def _q(wh):  # noqa: F811
    return dedup.orders_with_duplicates(wh.order_details())


@register("duplicate_candidates")
def _q(wh):  # noqa: F811
    return dedup.duplicate_candidates(_lines_with_rec(wh))


@register("duplicate_rec_nos")
def _q(wh):  # noqa: F811
    return dedup.duplicate_rec_nos(_lines_with_rec(wh))


@register("dedup_order_details")
def _q(wh):  # noqa: F811
    return facts.dedup_order_details(wh).select(
        "orderid", "productid", F.col("unitprice").cast("double").alias("unitprice"), "quantity",
        F.col("gross").cast("double").alias("gross"),
        F.col("discount").cast("double").alias("discount"))


@register("duplicate_summary")
def _q(wh):  # noqa: F811
    return dedup.duplicate_summary(wh.order_details())


# ----------------------------------------------------------------- facts
@register("sales_fact")
def _q(wh):  # noqa: F811
    f = facts.sales_fact(wh)
    return f.select("date_key", "customer_key", "product_key", "employee_key", "orderid",
                    F.col("unit_price").cast("double").alias("unit_price"),
                    F.col("gross_amount").cast("double").alias("gross_amount"), "quantity",
                    F.col("discount").cast("double").alias("discount"),
                    F.col("line_total").cast("double").alias("line_total"))


@register("star_sales")
def _q(wh):  # noqa: F811
    return facts.star_sales(wh)


# --------------------------------------------------------------- library
def _lib(key, fn):
    register(key)(lambda wh: fn(wh))


_lib("membership_utilisation_month", library.membership_utilisation_month)
_lib("overdue_month", library.overdue_month)
_lib("overdue_member_behaviour", library.overdue_member_behaviour)
_lib("repeat_offenders", library.repeat_offenders)
_lib("staff_workload", library.staff_workload)
_lib("staff_buckets", library.staff_buckets)
_lib("staff_report", library.staff_report)
_lib("overdue_by_period", lambda wh: library.overdue_by_period(wh, "quarter", True))
_lib("avg_utilisation", library.avg_utilisation)
_lib("high_utilisation_members", library.high_utilisation_members)
_lib("overdue_above_average", library.overdue_above_average)
_lib("overdue_by_region", library.overdue_by_region)
_lib("overdue_by_category", library.overdue_by_category)
_lib("staff_month_average", library.staff_month_average)
_lib("staff_underperforming", library.staff_underperforming)
_lib("staff_top3", lambda wh: library.staff_top3(wh, PAST_YEAR_START, REPORT_END))
_lib("staff_underperforming_quarter",
     lambda wh: library.staff_underperforming(wh, PAST_QUARTER_START, REPORT_END))
_lib("staff_underperforming_year",
     lambda wh: library.staff_underperforming(wh, PAST_YEAR_START, REPORT_END))
_lib("reservation_processing", library.reservation_processing)
_lib("overdue_peak", library.overdue_peak)
_lib("duration_vs_overdue", library.duration_vs_overdue)
_lib("staff_member_interactions", library.staff_member_interactions)


# ------------------------------------------------------------ generators
@register("replicate_customers")
def _q(wh):  # noqa: F811
    return generate.replicate_customers(wh, 6)


@register("generate_orders")
def _q(wh):  # noqa: F811
    o = generate.generate_orders(wh)
    return o.withColumn("freight", F.col("freight").cast("double"))


@register("generate_order_details")
def _q(wh):  # noqa: F811
    d = generate.generate_order_details(wh, check_missing=True)
    return (d.withColumn("unitprice", F.col("unitprice").cast("double"))
            .withColumn("discount", F.col("discount").cast("double")))


# ------------------------------------------------- enrollment and type 2
def _enrollment_out(f):
    return (f.withColumn("fee_per_credit", F.col("fee_per_credit").cast("double"))
            .withColumn("total_fees", F.col("total_fees").cast("double")))


@register("enrollment_fact")
def _q(wh):  # noqa: F811
    return _enrollment_out(facts.enrollment_fact(wh))


@register("enrollment_fact_literal")
def _q(wh):  # noqa: F811
    """The source's load as written: every course version joins (fan-out)."""
    return _enrollment_out(facts.enrollment_fact(wh, literal_course_join=True))


@register("scd2_lookup")
def _q(wh):  # noqa: F811
    e = wh.enrollments().withColumn("register_date", F.to_date("register_ts"))
    j = scd2.scd2_lookup(e, wh.courses(), "course_id", "register_date")
    line_ids = [c for c in ("linenumber", "suppkey") if c in e.columns]  # when the source has them
    return j.select("se_id", *line_ids, "course_id", "register_date", "version")


@register("scd2_merge_lookup")
def _q(wh):  # noqa: F811
    """scd2_lookup again, as an ordered merge of enrollments and course versions."""
    e = wh.enrollments().withColumn("register_date", F.to_date("register_ts"))
    j = scd2.scd2_merge_lookup(e, wh.courses().select("course_id", "version", "effective_start_date", "effective_end_date"),
                               "course_id", "register_date")
    line_ids = [c for c in ("linenumber", "suppkey") if c in e.columns]
    return j.select("se_id", *line_ids, "course_id", "register_date", "version")


@register("scd2_changes")
def _q(wh):  # noqa: F811
    """Course titles: the versions of the catalogue (the second one in capitals), then
    every enrollment as a dated change of its course: a new edition, or for some
    of those graded R a deletion. One in fifty is of a course that the catalogue lacks."""
    c = wh.courses().withColumn("course_title", F.when(F.col("version") == 2, F.upper("course_title")).otherwise(F.col("course_title")))
    dim = surrogate_key(c.select("course_id", "course_title", "effective_start_date", "effective_end_date"),
                        ["course_id", "effective_start_date"], "sk", 1)
    dim = materialize(dim.withColumn("current_flag", F.when(F.col("effective_end_date") == F.lit(scd2.OPEN_END), "Y").otherwise("N")), "versions")
    e = wh.enrollments()
    number = F.col("linenumber") if "linenumber" in e.columns else F.lit(0)
    gone = (F.col("grade") == "R") & (F.col("se_id") % 4 == 0)
    log = e.select(F.when(F.col("se_id") % 50 == 0, F.col("course_id") + 1_000_000_000).otherwise(F.col("course_id")).alias("course_id"),
                   F.to_date("register_ts").alias("change_date"), F.when(gone, "D").otherwise("U").alias("op"),
                   (F.col("se_id") * 8 + number).alias("change_seq"),
                   F.concat(F.lit("Edition "), (F.col("se_id") % 3).cast("string")).alias("course_title"))
    return scd2.scd2_changes(dim, log, ["course_id"], ["course_title"], "sk")


@register("scd2_apply")
def _q(wh):  # noqa: F811
    """Course titles as a type-2 dimension: first load as of 1900-01-01,
    then a snapshot (titles of every fifth course re-written in capitals)
    applied as of 1998-01-01."""
    p = wh.products().select(F.col("productid").alias("course_id"), F.col("productname").alias("p_name"))
    first = scd2.initial_versions(p.select("course_id", F.col("p_name").alias("course_title")),
                                  ["course_id"], dt.date(1900, 1, 1), "sk", 1)
    snap = p.select("course_id",
                    F.when(F.col("course_id") % 5 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
                    .alias("course_title"))
    return scd2.scd2_apply(first.select("sk", "course_id", "course_title", "effective_start_date",
                                        "effective_end_date", "current_flag"),
                           snap, ["course_id"], ["course_title"], dt.date(1998, 1, 1), "sk")
_lib("overdue_by_year", lambda wh: library.overdue_by_period(wh, "year", True))
_lib("overdue_by_event", lambda wh: library.overdue_by_period(wh, "event", False))
_lib("duration_vs_overdue_month", lambda wh: library.duration_vs_overdue(wh, period="month"))
_lib("duration_vs_overdue_year", lambda wh: library.duration_vs_overdue(wh, period="year"))


@register("academic_year_windows")
def _q(wh):  # noqa: F811
    """Two windows with starts and ends of their own; other days keep their value."""
    dim = calendar.date_dim(wh).select("date_key", "cal_date", F.lit("none").alias("acad_year"))
    return calendar.academic_year(dim, calendar.ACADEMIC_EXAMPLE)


_lib("overdue_by_holiday", lambda wh: library.overdue_by_period(wh, "holiday", False))
_lib("overdue_by_academic_year", lambda wh: library.overdue_by_period(wh, "academic_year", False))


@register("delete_duplicates")
def _q(wh):  # noqa: F811
    """The source's literal path: number the lines, mark every line after
    the first of its (order, product), delete the marked record numbers."""
    disc = "l_discount" if "l_discount" in wh.order_lines().columns else "discount"   # source value
    rec = _lines_with_rec(wh, "quantity", disc)
    kept = dedup.delete_by_rec_no(rec, materialize(dedup.duplicate_rec_nos(rec), "marked-lines"))
    return kept.select("rec_no", "orderid", "productid", "quantity",
                       F.col(disc).cast("double").alias("discount"))


_lib("overdue_by_regional_holiday", library.overdue_by_regional_holiday)
_lib("overdue_by_regional_event", library.overdue_by_regional_event)
_lib("avg_utilisation_rollup", lambda wh: rollup.avg_utilisation(rollup.stored_rollup(wh)))
_lib("active_members_quarter", lambda wh: rollup.active_members(rollup.stored_rollup(wh)))
