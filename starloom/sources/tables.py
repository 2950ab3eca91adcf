"""Adapters from the supplied parquet tables to the warehouse roles.

``Warehouse`` reads each parquet table lazily (Catalyst prunes columns and
pushes filters into the scan) and exposes the source roles of the retail,
library and enrollment marts: customers, products, orders, order lines,
members, staff, book loans, reservations, students, courses, enrollments.
The same definitions exist as SQL views in ``starloom.sources.sql``.

Joins to tables whose size is fixed by the schema (25 nations, 5 regions)
are broadcast explicitly; every other join is left to the planner and AQE,
which broadcasts a side only when its measured size is below the
threshold and sort-merges otherwise.
"""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.scalar import money, net_amount, round_ratio

# Natural order of a line: every column, so the order is total.
LINE_ORDER = ["orderid", "productid", "suppkey", "linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Membership terms by customer segment
# segment -> (membership type, max book loans, max reservations, loan duration days)
MEMBERSHIP_TERMS = {
    "AUTOMOBILE": ("Basic", 1, 1, 7),
    "BUILDING": ("Standard", 2, 1, 14),
    "FURNITURE": ("Premium", 2, 2, 21),
    "HOUSEHOLD": ("Student", 0, 0, 14),
    "MACHINERY": ("Institutional", 3, 2, 28),
}

# Report window and reference date of the library reports
REPORT_START = dt.date(1999, 1, 1)
REPORT_END = dt.date(2000, 6, 30)
REFERENCE_DATE = dt.date(2000, 6, 30)
# the staff questions also look at the past quarter and the past year
PAST_QUARTER_START = dt.date(2000, 4, 1)
PAST_YEAR_START = dt.date(1999, 7, 1)

# The course-version split of the enrollment mart
COURSE_VERSION_SPLIT = dt.date(1998, 1, 1)
COURSE_VERSION_OPEN_END = dt.date(9999, 12, 31)

# Every seventh member has a second version from this day on (within
# a month of the report window), and staff ids follow this number
MEMBER_RENEWAL, STAFF_ID_START = dt.date(1999, 10, 15), 1000


def ts_lit(d: dt.date) -> Column:
    """Timestamp-without-zone literal at midnight of ``d``; comparing the raw
    ``timestamp_ntz`` columns against it keeps the predicate pushable."""
    return F.expr(f"TIMESTAMP_NTZ '{d.isoformat()} 00:00:00'")


def day_window(col: str, start: dt.date | None, end: dt.date | None) -> Column | None:
    """``cast(col as date) BETWEEN start AND end`` written on the raw timestamp
    so that parquet row-group statistics can skip data."""
    cond = None
    if start is not None:
        cond = F.col(col) >= ts_lit(start)
    if end is not None:
        c2 = F.col(col) < ts_lit(end + dt.timedelta(days=1))
        cond = c2 if cond is None else cond & c2
    return cond


class Warehouse:
    """Lazy access to one scale factor's tables and their warehouse roles."""

    # columns that put order lines in a total order (record numbers, "first" line)
    line_order = LINE_ORDER

    def __init__(self, spark: SparkSession, sf_dir: str, days: tuple[dt.date, dt.date] | None = None):
        """``days``: first and last day of the facts, where they are known (say, from a
        stored calendar); else they are looked up when a plan needs them."""
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._days = days
        self._memo: dict = {}
        self._locks: dict = {}

    def memo(self, name: str, build):
        """Build a derived table once per warehouse object (dimensions whose
        keys are materialised are shared by every plan that joins them).
        Safe for the concurrent dimension builds: one lock per name, so
        different tables still build in parallel."""
        with self._locks.setdefault(name, threading.RLock()):
            if name not in self._memo:
                self._memo[name] = build()
        return self._memo[name]

    # ---------------------------------------------------------------- raw
    def raw(self, name: str) -> DataFrame:
        """The supplied table ``name``; listed and its footer read once per
        warehouse object (listing a large table on object storage is slow)."""
        return self.memo(f"raw:{name}",
                         lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet"))

    def _nation_region(self) -> DataFrame:
        # 25 nations and 5 regions at every scale: broadcast is size-safe.
        n = self.raw("nation")
        r = self.raw("region")
        return F.broadcast(
            n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"))

    def _supplier_count(self):
        """How many suppliers there are: products and desks are spread over all of them."""
        return F.nullif(self.raw("supplier").agg(F.count(F.lit(1))).scalar(), F.lit(0))

    def _day_columns(self) -> list[tuple[DataFrame, str]]:
        """Tables and their columns of days that a fact refers to: order and ship days."""
        return [(self.raw("orders"), "o_orderdate"), (self.raw("lineitem"), "l_shipdate")]

    def fact_bounds(self) -> tuple[dt.date | None, dt.date | None]:
        """First and last day that a fact refers to. Each table's raw column is
        aggregated once for a warehouse object, so plans that need a calendar hold two
        dates and no scan of the facts."""
        def find():
            ends = [t.agg(F.to_date(F.min(c)), F.to_date(F.max(c))).first() for t, c in self._day_columns()]
            low, high = ([x for x in side if x is not None] for side in zip(*ends))
            return min(low, default=None), max(high, default=None)
        return self._days or self.memo("fact_bounds", find)

    # -------------------------------------------------------------- retail
    def customers(self) -> DataFrame:
        """customerid, companyname, contactname, city, region, postalcode, country.
        Region is NULL for every third id, postal code for every tenth."""
        c = self.raw("customer").select("c_custkey", "c_name", "c_nationkey")
        nr = self._nation_region()
        k = F.col("c_custkey")
        return (c.join(nr, c.c_nationkey == nr.n_nationkey, "left")  # a missing nation is for the checks to find
                .select(k.alias("customerid"),
                        F.col("c_name").alias("companyname"),
                        F.col("n_name").alias("city"),
                        F.when(k % 3 == 0, F.lit(None).cast("string"))
                         .otherwise(F.col("r_name")).alias("region"),
                        F.when(k % 10 == 0, F.lit(None).cast("string"))
                         .otherwise(F.lpad(k.cast("string"), 5, "0")).alias("postalcode"),
                        F.col("n_name").alias("country")))

    def suppliers(self) -> DataFrame:
        s = self.raw("supplier").select("s_suppkey", "s_name", "s_nationkey")
        nr = self._nation_region()
        return (s.join(nr, s.s_nationkey == nr.n_nationkey)
                .select(F.col("s_suppkey").alias("supplierid"),
                        F.col("s_name").alias("companyname"),
                        F.col("n_name").alias("city"),
                        F.col("n_name").alias("country")))

    def products(self) -> DataFrame:
        """productid, productname, supplierid, categoryname, quantityperunit,
        unitprice decimal(12,2), discontinued."""
        p = self.raw("part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
        return p.select(F.col("p_partkey").alias("productid"),
                        F.col("p_name").alias("productname"),
                        (F.col("p_partkey") % self._supplier_count()).alias("supplierid"),
                        F.col("p_type").alias("categoryname"),
                        F.col("p_size").cast("string").alias("quantityperunit"),
                        money("p_retailprice", 12, 2).alias("unitprice"),
                        F.lit(0).alias("discontinued"))

    def employees(self) -> DataFrame:
        """Nine employees (ids 1-9) drawn from supplier rows 0-8."""
        s = self.suppliers().filter(F.col("supplierid").between(0, 8))
        eid = (F.col("supplierid") + 1)
        parts = F.split(F.col("companyname"), "#")
        return s.select(eid.alias("employeeid"),
                        parts.getItem(1).alias("lastname"),
                        parts.getItem(0).alias("firstname"),
                        F.date_add(F.lit(dt.date(1992, 1, 1)), (eid * 100).cast("int")).alias("hiredate"),
                        F.col("city"), F.col("country"))

    def shippers(self) -> DataFrame:
        """Shippers = the distinct order priorities: id = leading digit."""
        o = self.raw("orders").select("o_orderpriority")
        return (o.select(F.substring("o_orderpriority", 1, 1).cast("bigint").alias("shipperid"),
                         F.substring("o_orderpriority", 3, 100).alias("companyname"))
                .distinct())

    def orders(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """orderid, customerid, employeeid, orderdate, requireddate, shippeddate, shipvia.
        ``start``/``end`` filter order days in the scan."""
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        cond = day_window("o_orderdate", start, end)
        if cond is not None:
            o = o.filter(cond)
        d = F.to_date("o_orderdate")
        return o.select(F.col("o_orderkey").alias("orderid"),
                        F.col("o_custkey").alias("customerid"),
                        (F.col("o_orderkey") % 9 + 1).alias("employeeid"),
                        d.alias("orderdate"),
                        F.date_add(d, 7).alias("requireddate"),
                        F.date_add(d, 3).alias("shippeddate"),
                        F.substring("o_orderpriority", 1, 1).cast("bigint").alias("shipvia"))

    def order_lines(self) -> DataFrame:
        """Every line with its full natural ordering columns (full rows are
        unique; (orderid, productid) is not). The supplied lines have an extended
        amount; their unit price is that over the quantity, in cents."""
        li = self.raw("lineitem")
        price = round_ratio((money("l_extendedprice") * 100).cast("bigint"), F.col("l_quantity").cast("bigint") * 100)
        return li.select(F.col("l_orderkey").alias("orderid"),
                         F.col("l_partkey").alias("productid"),
                         F.col("l_suppkey").alias("suppkey"),
                         F.col("l_linenumber").alias("linenumber"),
                         F.col("l_quantity").cast("bigint").alias("quantity"),
                         money("l_extendedprice").alias("gross"),
                         money("l_discount", 3, 2).alias("discount"),
                         price.cast("decimal(12,2)").alias("unitprice"),
                         F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"),
                         F.col("l_tax"), F.col("l_returnflag"), F.col("l_linestatus"),
                         F.col("l_shipdate"))

    def order_details(self) -> DataFrame:
        """orderid, productid, quantity, gross, discount, net (2 decimals)."""
        return (self.order_lines()
                .select("orderid", "productid", "quantity", "gross", "discount",
                        net_amount("gross", "discount").alias("net")))

    # ------------------------------------------------------------- library
    @staticmethod
    def _member_key(customer, day):
        """Key of the member version of a day."""
        return customer * 2 + ((customer % 7 == 0) & (day >= F.lit(MEMBER_RENEWAL))).cast("bigint")

    def members(self) -> DataFrame:
        """DIM_Member: one version per customer, two of every seventh."""
        c = self.raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        versions = F.when(F.col("c_custkey") % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        c = c.withColumn("version", F.explode(versions))
        nr = self._nation_region()
        terms = F.create_map(*[x for seg, (t, mb, mr, ld) in MEMBERSHIP_TERMS.items()
                               for x in (F.lit(seg), F.struct(F.lit(t).alias("t"),
                                                              F.lit(mb).alias("mb"),
                                                              F.lit(mr).alias("mr"),
                                                              F.lit(ld).alias("ld")))])
        k = F.col("c_custkey")
        term = terms[F.col("c_mktsegment")]
        return (c.join(nr, c.c_nationkey == nr.n_nationkey)
                .select((k * 2 + F.col("version")).alias("member_key"), k.alias("memberid"),
                        term["t"].alias("membershiptype"),
                        term["mb"].cast("bigint").alias("maxbookloan"),
                        term["mr"].cast("bigint").alias("maxreservation"),
                        term["ld"].cast("bigint").alias("loanduration"),
                        F.when(k % 50 == 0, F.lit(None).cast("date"))
                         .otherwise(F.date_add(F.lit(dt.date(1925, 1, 1)),
                                               ((k * 7919) % 27000).cast("int"))).alias("dob"),
                        F.when(k % 3 == 0, F.lit(None).cast("string"))
                         .otherwise(F.col("r_name")).alias("region")))

    def staff(self) -> DataFrame:
        """DIM_Staff: salary NULL for every 25th supplier."""
        s = self.raw("supplier").select("s_suppkey", "s_acctbal")
        k = F.col("s_suppkey")
        return s.select(k.alias("staff_key"), (k + STAFF_ID_START).alias("staffid"),
                        F.when(k % 25 == 24, F.lit(None).cast("decimal(10,2)"))
                         .otherwise(money("s_acctbal", 10, 2)).alias("salary"))

    def book_loans(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """FACT_BookLoan with the borrowing member's attributes attached.

        The loan window filters the lineitem scan; the order and member
        lookups are key joins the planner sizes at run time.
        """
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                         "l_shipdate")
        cond = day_window("l_shipdate", start, end)
        if cond is not None:
            li = li.filter(cond)
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        m = self.members()
        loandays = (F.lit(1) + (F.col("l_orderkey") * 7 + F.col("l_partkey") * 13
                                + F.col("l_linenumber")) % 40)
        j = (li.join(o, li.l_orderkey == o.o_orderkey)
             .join(m, self._member_key(F.col("o_custkey"), F.to_date("l_shipdate")) == m.member_key))
        return j.select(
            "member_key", "memberid", "membershiptype", "maxbookloan", "maxreservation",
            "loanduration", "dob", "region",
            F.col("l_partkey").alias("booktitle_key"),
            F.col("l_suppkey").alias("staff_key"),
            F.to_date("l_shipdate").alias("loan_date"),
            F.col("l_orderkey").alias("orderkey"),
            F.col("l_linenumber").alias("linenumber"),
            loandays.cast("bigint").alias("loandays"),
            F.when(F.col("l_orderkey") % 97 == 0, F.lit(None).cast("bigint"))
             .otherwise(F.greatest(loandays - F.col("loanduration"), F.lit(0))).cast("bigint")
             .alias("overduedays"))

    def loan_keys(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """(staff_key, member_key) of each loan: no member lookup."""
        li = self.raw("lineitem").select("l_orderkey", "l_suppkey", "l_shipdate")
        cond = day_window("l_shipdate", start, end)
        li = li if cond is None else li.filter(cond)
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("l_suppkey").alias("staff_key"), self._member_key(F.col("o_custkey"), F.to_date("l_shipdate")).alias("member_key"))

    def staff_loans(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """(staff_key, loan_date) of each loan: the loan fact alone, no member lookup."""
        li = self.raw("lineitem").select("l_suppkey", "l_shipdate")
        cond = day_window("l_shipdate", start, end)
        li = li if cond is None else li.filter(cond)
        return li.select(F.col("l_suppkey").alias("staff_key"), F.to_date("l_shipdate").alias("loan_date"))

    def reservations(self, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
        """FACT_Reservation, one per order."""
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
        cond = day_window("o_orderdate", start, end)
        if cond is not None:
            o = o.filter(cond)
        return o.select(self._member_key(F.col("o_custkey"), F.to_date("o_orderdate")).alias("member_key"),
                        (F.col("o_orderkey") % self._supplier_count()).alias("staff_key"),
                        F.to_date("o_orderdate").alias("resv_date"),
                        F.col("o_orderkey").alias("reservationid"),
                        F.when(F.col("o_orderstatus") == "F", "Success").otherwise("Cancelled")
                         .alias("reservationstatus"),
                        F.expr("(1 + o_orderkey % 14) div 2").alias("reservetoreadydays"),
                        # a cancelled reservation never succeeds
                        F.when(F.col("o_orderstatus") == "F", F.expr("1 + o_orderkey % 14 - (1 + o_orderkey % 14) div 2"))
                         .alias("readytosuccessdays"),
                        (F.lit(1) + F.col("o_orderkey") % 14).cast("bigint").alias("totaldays"))

    def book_titles(self) -> DataFrame:
        p = self.raw("part").select("p_partkey", "p_type")
        return p.select(F.col("p_partkey").alias("booktitle_key"),
                        F.col("p_type").alias("category"))

    # ---------------------------------------------------------- enrollment
    def students(self) -> DataFrame:
        c = self.raw("customer").select("c_custkey", "c_name", "c_nationkey")
        nr = self._nation_region()
        return (c.join(nr, c.c_nationkey == nr.n_nationkey)
                .select(F.col("c_custkey").alias("s_id"), F.col("c_name").alias("s_name"),
                        F.col("n_name").alias("s_country"), F.col("r_name").alias("s_state")))

    def courses(self) -> DataFrame:
        """Course versions (type 2): parts with ``p_partkey % 5 = 0`` have two
        versions split at 1998-01-01, the rest one open version."""
        p = self.raw("part").select("p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
        base = p.select(F.col("p_partkey").alias("course_id"),
                        F.col("p_name").alias("course_title"),
                        F.col("p_type").alias("faculty_name"),
                        F.col("p_size").cast("bigint").alias("max_capacity"),
                        money("p_retailprice", 12, 2).alias("fee_per_credit"),
                        (F.col("p_size") % 4 + 1).cast("bigint").alias("credit_hour"))
        two = F.col("course_id") % 5 == 0
        # one row per version: explode(1 or 2 versions) keeps it a narrow map
        versions = F.when(two, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
        v = base.withColumn("version", F.explode(versions))
        start = (F.when(F.col("version") == 2, F.lit(COURSE_VERSION_SPLIT))
                 .otherwise(F.lit(dt.date(1900, 1, 1))))
        end = (F.when(F.col("version") == 1, F.date_sub(F.lit(COURSE_VERSION_SPLIT), 1))
               .otherwise(F.lit(COURSE_VERSION_OPEN_END)))
        return v.select("course_id", "course_title", "faculty_name", "max_capacity",
                        "fee_per_credit", "credit_hour", "version",
                        start.alias("effective_start_date"), end.alias("effective_end_date"))

    def enrollments(self) -> DataFrame:
        """One course enrollment per order line: semester enrollment = order,
        student = customer, course = part, register date = ship day,
        grade = return flag."""
        li = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                         "l_returnflag", "l_shipdate", "l_suppkey")
        o = self.raw("orders").select("o_orderkey", "o_custkey")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("l_orderkey").alias("se_id"),
                        F.col("o_custkey").alias("s_id"),
                        F.col("l_partkey").alias("course_id"),
                        F.col("l_linenumber").alias("linenumber"),
                        F.col("l_suppkey").alias("suppkey"),
                        F.col("l_shipdate").alias("register_ts"),
                        F.col("l_returnflag").alias("grade")))
