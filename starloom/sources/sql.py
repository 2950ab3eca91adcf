"""The warehouse roles of ``starloom.sources.tables`` as SQL views.

These are the DuckDB/ANSI twins used by the oracle queries: each role is a
CTE over the supplied tables, written with the same rules as the Spark
adapters. ``with_views(body, "cust", "ord", ...)`` prefixes a query with the
CTEs it needs (dependencies included).
"""

from __future__ import annotations

import datetime as dt

from starloom.sources.tables import MEMBER_RENEWAL, MEMBERSHIP_TERMS, STAFF_ID_START


def _d(d: dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def _terms_case(idx: int, cast: str | None = None) -> str:
    whens = []
    for seg, vals in MEMBERSHIP_TERMS.items():
        v = vals[idx]
        v = f"'{v}'" if isinstance(v, str) else str(v)
        whens.append(f"WHEN '{seg}' THEN {v}")
    e = f"CASE c.c_mktsegment {' '.join(whens)} END"
    return f"CAST({e} AS {cast})" if cast else e


def _version(customer: str, day: str) -> str:
    return (f"CASE WHEN {customer} % 7 = 0 AND {day} >= TIMESTAMP '{MEMBER_RENEWAL.isoformat()}' "
            f"THEN 2 * {customer} + 1 ELSE 2 * {customer} END")


VIEWS: dict[str, str] = {
    "nr": """SELECT n.n_nationkey, n.n_name, r.r_name
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "cust": """SELECT c.c_custkey AS customerid, c.c_name AS companyname, nr.n_name AS city,
                  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE nr.r_name END AS region,
                  CASE WHEN c.c_custkey % 10 = 0 THEN NULL
                       ELSE lpad(CAST(c.c_custkey AS VARCHAR), 5, '0') END AS postalcode,
                  nr.n_name AS country
               FROM customer c LEFT JOIN nr ON c.c_nationkey = nr.n_nationkey""",
    "supp": """SELECT s.s_suppkey AS supplierid, s.s_name AS companyname, nr.n_name AS city,
                  nr.n_name AS country
               FROM supplier s JOIN nr ON s.s_nationkey = nr.n_nationkey""",
    "prod": """SELECT p_partkey AS productid, p_name AS productname, p_partkey % (SELECT count(*) FROM supplier) AS supplierid,
                  p_type AS categoryname, CAST(p_size AS VARCHAR) AS quantityperunit,
                  CAST(p_retailprice AS DECIMAL(12,2)) AS unitprice, 0 AS discontinued
               FROM part""",
    "emp": """SELECT supplierid + 1 AS employeeid, split_part(companyname, '#', 2) AS lastname,
                 split_part(companyname, '#', 1) AS firstname,
                 DATE '1992-01-01' + CAST((supplierid + 1) * 100 AS INTEGER) AS hiredate,
                 city, country
              FROM supp WHERE supplierid BETWEEN 0 AND 8""",
    "ship": """SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS shipperid,
                  substr(o_orderpriority, 3, 100) AS companyname
               FROM orders""",
    "ord": """SELECT o_orderkey AS orderid, o_custkey AS customerid, o_orderkey % 9 + 1 AS employeeid,
                 CAST(o_orderdate AS DATE) AS orderdate,
                 CAST(o_orderdate AS DATE) + 7 AS requireddate,
                 CAST(o_orderdate AS DATE) + 3 AS shippeddate,
                 CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS shipvia
              FROM orders""",
    "lines": """SELECT l_orderkey AS orderid, l_partkey AS productid, l_suppkey AS suppkey,
                   l_linenumber AS linenumber, CAST(l_quantity AS BIGINT) AS quantity,
                   CAST(l_extendedprice AS DECIMAL(18,2)) AS gross,
                   CAST(l_discount AS DECIMAL(3,2)) AS discount,
                   CAST((2 * CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) + CAST(l_quantity AS BIGINT))
                        // nullif(2 * CAST(l_quantity AS BIGINT), 0) AS DECIMAL(18,2)) / 100 AS unitprice,
                   l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
                   l_shipdate
                FROM lineitem""",
    "det": """SELECT orderid, productid, quantity, gross, discount,
                 CAST(round(gross * (1 - discount), 2) AS DECIMAL(18,2)) AS net
              FROM lines""",
    "mem": f"""SELECT 2 * c.c_custkey + version AS member_key, c.c_custkey AS memberid,
                  {_terms_case(0)} AS membershiptype,
                  {_terms_case(1, 'BIGINT')} AS maxbookloan,
                  {_terms_case(2, 'BIGINT')} AS maxreservation,
                  {_terms_case(3, 'BIGINT')} AS loanduration,
                  CASE WHEN c.c_custkey % 50 = 0 THEN NULL
                       ELSE DATE '1925-01-01' + CAST((c.c_custkey * 7919) % 27000 AS INTEGER) END AS dob,
                  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE nr.r_name END AS region
               FROM customer c JOIN nr ON c.c_nationkey = nr.n_nationkey
               JOIN (VALUES (0), (1)) versions(version) ON version = 0 OR c.c_custkey % 7 = 0""",
    "stf": f"""SELECT s_suppkey AS staff_key, {STAFF_ID_START} + s_suppkey AS staffid,
                 CASE WHEN s_suppkey % 25 = 24 THEN NULL ELSE CAST(s_acctbal AS DECIMAL(10,2)) END AS salary
              FROM supplier""",
    "loan_all": f"""SELECT m.*, l.l_partkey AS booktitle_key, l.l_suppkey AS staff_key,
                      CAST(l.l_shipdate AS DATE) AS loan_date, l.l_orderkey AS orderkey,
                      l.l_linenumber AS linenumber,
                      CAST(1 + (l.l_orderkey * 7 + l.l_partkey * 13 + l.l_linenumber) % 40 AS BIGINT) AS loandays,
                      CAST(CASE WHEN l.l_orderkey % 97 = 0 THEN NULL
                           ELSE greatest(1 + (l.l_orderkey * 7 + l.l_partkey * 13 + l.l_linenumber) % 40
                                         - m.loanduration, 0) END AS BIGINT) AS overduedays
                   FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                   JOIN mem m ON {_version('o.o_custkey', 'l.l_shipdate')} = m.member_key""",
    "resv_all": f"""SELECT {_version('o_custkey', 'o_orderdate')} AS member_key, o_orderkey % (SELECT count(*) FROM supplier) AS staff_key,
                      CAST(o_orderdate AS DATE) AS resv_date, o_orderkey AS reservationid,
                      CASE WHEN o_orderstatus = 'F' THEN 'Success' ELSE 'Cancelled' END AS reservationstatus,
                      CAST((1 + o_orderkey % 14) // 2 AS BIGINT) AS reservetoreadydays,
                      CAST(CASE o_orderstatus WHEN 'F' THEN (2 + o_orderkey % 14) // 2 END AS BIGINT) AS readytosuccessdays,
                      CAST(1 + o_orderkey % 14 AS BIGINT) AS totaldays
                   FROM orders""",
    "titles": "SELECT p_partkey AS booktitle_key, p_type AS category FROM part",
}

DEPS: dict[str, list[str]] = {
    "cust": ["nr"], "supp": ["nr"], "emp": ["supp"], "det": ["lines"], "mem": ["nr"],
    "loan_all": ["mem"], "loan": ["loan_all"], "resv": ["resv_all"],
}


def window_views(start: dt.date, end: dt.date) -> dict[str, str]:
    """Loans and reservations restricted to a report window (inclusive days)."""
    return {
        "loan": f"SELECT * FROM loan_all WHERE loan_date BETWEEN {_d(start)} AND {_d(end)}",
        "resv": f"SELECT * FROM resv_all WHERE resv_date BETWEEN {_d(start)} AND {_d(end)}",
    }


def with_views(body: str, *names: str, extra: dict[str, str] | None = None,
               extra_deps: dict[str, list[str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs ``names`` need, dependencies first."""
    views = dict(VIEWS)
    deps = dict(DEPS)
    if extra:
        views.update(extra)
    if extra_deps:
        deps.update(extra_deps)
    ordered: list[str] = []

    def visit(n: str) -> None:
        if n in ordered:
            return
        for d in deps.get(n, []):
            visit(d)
        ordered.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({views[n]})" for n in ordered)
    return f"WITH {ctes}\n{body}" if ctes else body
