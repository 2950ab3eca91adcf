"""Warehouse roles read from tables already in the warehouse shapes.

``RoleWarehouse(spark, dir)`` serves every plan of the library from parquet
tables named after the roles, e.g. a retail system's own customers, orders
and order details, or a library's members, loans and reservations:

    customers       customerid, companyname, city, region, postalcode, country
    suppliers       supplierid, companyname, city, country
    products        productid, productname, supplierid, categoryname,
                    quantityperunit, unitprice, discontinued
    employees       employeeid, lastname, firstname, hiredate, city, country
    shippers        shipperid, companyname
    orders          orderid, customerid, employeeid, orderdate, requireddate,
                    shippeddate, shipvia
    order_details   orderid, productid, unitprice, quantity, discount
                    (an extra ``gross`` column, if present, is the line amount)
    members         member_key, memberid, membershiptype, maxbookloan,
                    maxreservation, loanduration, dob, region
    staff           staff_key, staffid, salary
    book_loans      member_key, booktitle_key, staff_key, loan_date, loandays,
                    overduedays
    reservations    member_key, staff_key, resv_date, reservationid,
                    reservationstatus, totaldays, and if known
                    reservetoreadydays, readytosuccessdays
    book_titles     booktitle_key, category
    students        s_id, s_name, s_country, s_state
    courses         course_id, course_title, faculty_name, max_capacity,
                    fee_per_credit, credit_hour, version, effective_start_date,
                    effective_end_date
    enrollments     se_id, s_id, course_id, register_date, grade

``export_roles`` writes the roles of any warehouse in these shapes.
Tables are read lazily; only the roles a plan uses are touched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.scalar import money, net_amount
from starloom.sources.io import write_table
from starloom.sources.tables import Warehouse

RETAIL_ROLES = ["customers", "suppliers", "products", "employees", "shippers", "orders",
                "order_details"]
LIBRARY_ROLES = ["members", "staff", "book_loans", "reservations", "book_titles"]
ENROLLMENT_ROLES = ["students", "courses", "enrollments"]


def _between(df: DataFrame, col: str, start: dt.date | None, end: dt.date | None) -> DataFrame:
    if start is not None:
        df = df.filter(F.col(col) >= F.lit(start))
    if end is not None:
        df = df.filter(F.col(col) <= F.lit(end))
    return df


class RoleWarehouse(Warehouse):
    """A warehouse whose roles are parquet tables ``{dir}/{role}``."""

    line_order = ["orderid", "productid", "unitprice", "quantity", "discount"]

    def role(self, name: str) -> DataFrame:
        return self.memo(f"role:{name}", lambda: self.spark.read.parquet(f"{self.sf_dir}/{name}"))

    def customers(self):
        return self.role("customers").select("customerid", "companyname", "city", "region",
                                             "postalcode", "country")

    def suppliers(self):
        return self.role("suppliers").select("supplierid", "companyname", "city", "country")

    def products(self):
        return self.role("products").select("productid", "productname", "supplierid", "categoryname",
                                            "quantityperunit", "unitprice", "discontinued")

    def employees(self):
        return self.role("employees").select("employeeid", "lastname", "firstname", "hiredate",
                                             "city", "country")

    def shippers(self):
        return self.role("shippers").select("shipperid", "companyname")

    def orders(self, start: dt.date | None = None, end: dt.date | None = None):
        o = self.role("orders").select("orderid", "customerid", "employeeid", "orderdate",
                                       "requireddate", "shippeddate", "shipvia")
        return _between(o, "orderdate", start, end)

    def order_lines(self):
        d = self.role("order_details")
        gross = (money("gross") if "gross" in d.columns
                 else money(F.col("unitprice").cast("decimal(12,2)") * F.col("quantity")))
        return d.select("orderid", "productid", F.col("unitprice").cast("decimal(12,2)").alias("unitprice"),
                        F.col("quantity").cast("bigint").alias("quantity"),
                        money("discount", 3, 2).alias("discount"), gross.alias("gross"))

    def order_details(self):
        return (self.order_lines()
                .select("orderid", "productid", "quantity", "gross", "discount",
                        net_amount("gross", "discount").alias("net")))

    def members(self):
        return self.role("members").select("member_key", "memberid", "membershiptype", "maxbookloan",
                                           "maxreservation", "loanduration", "dob", "region")

    def staff(self):
        return self.role("staff").select("staff_key", "staffid", "salary")

    def book_loans(self, start: dt.date | None = None, end: dt.date | None = None):
        lo = _between(self.role("book_loans"), "loan_date", start, end).select(
            "member_key", "booktitle_key", "staff_key", "loan_date", "loandays", "overduedays")
        return lo.join(self.members(), "member_key")

    def staff_loans(self, start: dt.date | None = None, end: dt.date | None = None):
        return _between(self.role("book_loans"), "loan_date", start, end).select("staff_key", "loan_date")

    def loan_keys(self, start: dt.date | None = None, end: dt.date | None = None):
        return _between(self.role("book_loans"), "loan_date", start, end).select("staff_key", "member_key")

    def _day_columns(self):
        """The fact roles that are there (a retail system has no loans)."""
        from pyspark.errors import AnalysisException
        found = [(self.role("orders"), "orderdate")]
        for role, day in (("book_loans", "loan_date"), ("reservations", "resv_date"), ("enrollments", "register_date")):
            try:
                found.append((self.role(role), day))
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
        return found

    def reservations(self, start: dt.date | None = None, end: dt.date | None = None):
        r = self.role("reservations")
        part = [F.col(c) if c in r.columns else F.lit(None).cast("bigint").alias(c)  # a source may know the total only
                for c in ("reservetoreadydays", "readytosuccessdays")]
        r = r.select("member_key", "staff_key", "resv_date", "reservationid", "reservationstatus", *part, "totaldays")
        return _between(r, "resv_date", start, end)

    def book_titles(self):
        return self.role("book_titles").select("booktitle_key", "category")

    def students(self):
        return self.role("students").select("s_id", "s_name", "s_country", "s_state")

    def courses(self):
        return self.role("courses")

    def enrollments(self):
        return self.role("enrollments").select(
            "se_id", "s_id", "course_id", F.col("register_date").alias("register_ts"), "grade")


def export_roles(wh: Warehouse, out_dir: str, roles: list[str] | None = None) -> dict[str, str]:
    """Write the roles of ``wh`` as parquet tables ``out_dir/{role}``."""
    out = out_dir.rstrip("/")
    frames = {
        "customers": wh.customers, "suppliers": wh.suppliers, "products": wh.products,
        "employees": wh.employees, "shippers": wh.shippers, "orders": wh.orders,
        "order_details": lambda: wh.order_lines().select(
            "orderid", "productid",
            F.lit(None).cast("decimal(12,2)").alias("unitprice") if "unitprice" not in
            wh.order_lines().columns else F.col("unitprice"),
            "quantity", "discount", "gross"),
        "members": wh.members, "staff": wh.staff,
        "book_loans": lambda: wh.book_loans().select(
            "member_key", "booktitle_key", "staff_key", "loan_date", "loandays", "overduedays"),
        "reservations": wh.reservations, "book_titles": wh.book_titles,
        "students": wh.students, "courses": wh.courses,
        "enrollments": lambda: wh.enrollments().select(
            "se_id", "s_id", "course_id", F.to_date("register_ts").alias("register_date"), "grade"),
    }
    paths = {}
    for name in roles or list(frames):
        paths[name] = f"{out}/{name}"
        write_table(frames[name](), paths[name])
    return paths
