"""SQL twins of the registered queries (DuckDB / ANSI over the supplied
tables). Each string answers the same question as the Spark plan of the
same key; the warehouse roles come from ``starloom.sources.sql``."""

from __future__ import annotations

from starloom.plans.calendar import HOLIDAY_RULES, REGIONAL_RULES
from starloom.sources.sql import VIEWS, window_views, with_views
from starloom.sources.tables import (LINE_ORDER, PAST_QUARTER_START, PAST_YEAR_START, REPORT_END,
                                    REPORT_START)

_LINE_ORDER_SQL = ", ".join(f"{c} NULLS FIRST" for c in LINE_ORDER)


def _q(s: str) -> str:
    return s.replace("'", "''")


_HOLIDAY_VALUES = ", ".join(f"({m}, {d}, '{_q(e)}')" for m, d, e in HOLIDAY_RULES)

EXTRA = {
    "bounds": """SELECT make_date(year(min(d)), 1, 1) AS s, make_date(year(max(d)), 12, 31) AS e
                 FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)""",
    "days": """SELECT s, CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP),
                                                      INTERVAL 1 DAY)) AS DATE) AS cal_date
               FROM bounds""",
    "cal": """SELECT CAST(datediff('day', s, cal_date) + 100001 AS BIGINT) AS date_key, cal_date,
                 strftime(cal_date, '%Y %B %d') AS full_desc,
                 CAST(dayofweek(cal_date) + 1 AS BIGINT) AS day_week,
                 CAST(dayofmonth(cal_date) AS BIGINT) AS day_num_month,
                 CAST(dayofyear(cal_date) AS BIGINT) AS day_num_year,
                 CASE WHEN cal_date = last_day(cal_date) THEN 'Y' ELSE 'N' END AS last_day_ind,
                 CAST(cal_date + CAST(6 - dayofweek(cal_date) AS INTEGER) AS DATE) AS cal_week_end_date,
                 CAST(weekofyear(cal_date) AS BIGINT) AS cal_week_year,
                 upper(monthname(cal_date)) AS month_name,
                 CAST(month(cal_date) AS BIGINT) AS cal_month_year,
                 strftime(cal_date, '%Y-%m') AS cal_year_month,
                 'Q' || CAST(quarter(cal_date) AS VARCHAR) AS cal_quarter,
                 CAST(year(cal_date) AS VARCHAR) || '-Q' || CAST(quarter(cal_date) AS VARCHAR) AS cal_year_quarter,
                 CAST(year(cal_date) AS BIGINT) AS cal_year,
                 'N' AS holiday_ind,
                 CASE WHEN dayofweek(cal_date) BETWEEN 1 AND 5 THEN 'Y' ELSE 'N' END AS weekday_ind,
                 CAST(NULL AS VARCHAR) AS festive_event
              FROM days""",
    "rules": f"SELECT * FROM (VALUES {_HOLIDAY_VALUES}) AS t(h_month, h_day, festive_event)",
    "hol": """SELECT cal_date, string_agg(ev, '; ' ORDER BY ev) AS ev
              FROM (SELECT DISTINCT cal_date, substr(rules.festive_event, 1, 25) AS ev
                    FROM cal JOIN rules ON month(cal_date) = h_month AND day(cal_date) = h_day)
              GROUP BY cal_date""",
    "cd": """SELECT CAST(row_number() OVER (ORDER BY customerid) + 1233 AS BIGINT) AS customer_key,
                customerid, upper(companyname) AS companyname, upper(country) AS country,
                upper(coalesce(region, city)) AS region, upper(city) AS city,
                upper(coalesce(postalcode, '53300')) AS postalcode
             FROM cust""",
    "ed": """SELECT CAST(row_number() OVER (ORDER BY employeeid) + 1233 AS BIGINT) AS employee_key,
                employeeid, concat_ws('', firstname, ' ', lastname) AS emp_name, hiredate, country, city
             FROM emp""",
    "pd": """SELECT CAST(row_number() OVER (ORDER BY p.productid) + 1233 AS BIGINT) AS product_key,
                p.productid, upper(p.productname) AS productname,
                upper(p.quantityperunit) AS quantityperunit,
                CAST(p.discontinued AS BIGINT) AS discontinued, upper(p.categoryname) AS categoryname,
                upper(s.companyname) AS sup_companyname, upper(s.country) AS sup_country,
                upper(s.city) AS sup_city
             FROM prod p JOIN supp s ON p.supplierid = s.supplierid
             WHERE p.categoryname IS NOT NULL""",
    "recs": f"""SELECT CAST(row_number() OVER (ORDER BY {_LINE_ORDER_SQL}) AS BIGINT) AS rec_no, *
                FROM lines""",
    "nd": f"""SELECT orderid, productid, unitprice, quantity, gross, discount,
                 CAST(round(gross * (1 - discount), 2) AS DECIMAL(18,2)) AS net
              FROM (SELECT *, row_number() OVER (PARTITION BY orderid, productid
                                                ORDER BY {_LINE_ORDER_SQL}) AS rn FROM lines) x
              WHERE rn = 1""",
    "sf": """SELECT date_key, customer_key, product_key, employee_key, orderid,
                unitprice AS unit_price, gross AS gross_amount, quantity, discount, net AS line_total
             FROM nd JOIN ord USING (orderid)
             JOIN (SELECT productid, product_key FROM pd) USING (productid)
             JOIN (SELECT customerid, customer_key FROM cd) USING (customerid)
             JOIN (SELECT employeeid, employee_key FROM ed) USING (employeeid)
             JOIN (SELECT cal_date AS orderdate, date_key FROM cal) USING (orderdate)""",
}
EXTRA_DEPS = {
    "days": ["bounds"], "cal": ["days"], "hol": ["cal", "rules"], "cd": ["cust"], "ed": ["emp"],
    "pd": ["prod", "supp"], "recs": ["lines"], "nd": ["lines"],
    "sf": ["ord", "nd", "cal", "cd", "pd", "ed"], "counted": ["prod", "det"], "pj": ["prod", "supp"],
}


def sql(body: str, *names: str, extra: dict | None = None) -> str:
    views = dict(EXTRA)
    if extra:
        views.update(extra)
    return with_views(body, *names, extra=views, extra_deps=EXTRA_DEPS)


def rr(num: str, den: str, scale: int = 2) -> str:
    """Twin of ``round_ratio``: exact half-away-from-zero rounding of num/den."""
    f = 10 ** scale
    n = f"CAST({num} AS HUGEINT)"
    d = f"nullif(CAST({den} AS HUGEINT), 0)"
    return f"(CAST(sign({n}) * ((abs({n}) * {2 * f} + {d}) // (2 * {d})) AS DOUBLE) / {float(f)})"


def pct(part: str, whole: str) -> str:
    return rr(f"CAST({part} AS BIGINT) * 100", whole)


ORACLE: dict[str, str] = {}

# ----------------------------------------------------------------- retail
# what each order is worth, net of discounts
_ORDER_WORTH = "SELECT orderid, sum(gross * (1 - discount)) AS worth FROM det GROUP BY orderid"
ORACLE["customers_over_threshold"] = sql(f"""
SELECT customerid, companyname, CAST(round(spent, 2) AS DOUBLE) AS total_purchase
FROM cust JOIN (SELECT customerid, sum(worth) AS spent
                FROM ord JOIN ({_ORDER_WORTH}) USING (orderid)
                WHERE orderdate BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'
                GROUP BY customerid) USING (customerid)
WHERE spent > 1000""", "cust", "ord", "det")

ORACLE["customers_over_threshold_by_year"] = sql(f"""
SELECT customerid, companyname, order_year, CAST(round(spent, 2) AS DOUBLE) AS total_purchase
FROM cust JOIN (SELECT customerid, CAST(year(orderdate) AS BIGINT) AS order_year, sum(worth) AS spent
                FROM ord JOIN ({_ORDER_WORTH}) USING (orderid)
                GROUP BY ALL) USING (customerid)
WHERE spent > 1000""", "cust", "ord", "det")

_CATEGORY_COUNTS = """
SELECT categoryname, CAST(sum(n_lines) AS BIGINT) AS total_order
FROM prod JOIN (SELECT productid, count(*) AS n_lines FROM det SEMI JOIN ord USING (orderid)
                GROUP BY productid) USING (productid)
GROUP BY categoryname ORDER BY total_order DESC, categoryname"""
ORACLE["best_category"] = sql(_CATEGORY_COUNTS + " LIMIT 1", "prod", "det", "ord")
ORACLE["top3_categories"] = sql(_CATEGORY_COUNTS + " LIMIT 3", "prod", "det", "ord")

ORACLE["top_shipper"] = sql("""
SELECT companyname, CAST(sum(n_orders) AS BIGINT) AS total_orders
FROM ship JOIN (SELECT shipvia AS shipperid, count(*) AS n_orders FROM ord GROUP BY shipvia) USING (shipperid)
GROUP BY companyname ORDER BY total_orders DESC, companyname LIMIT 1""", "ord", "ship")

ORACLE["lapsed_customers"] = sql("""
SELECT customerid, max(orderdate) AS latest_purchase
FROM ord SEMI JOIN cust USING (customerid)
GROUP BY customerid
HAVING count(*) FILTER (WHERE orderdate BETWEEN DATE '1995-01-01' AND DATE '1995-12-31') = 0""", "cust", "ord")

_BY_COUNTRY_Q = """
SELECT country, 'Q' || CAST(quarter(orderdate) AS VARCHAR) AS cal_quarter, count(*) AS no_of_orders
FROM ord JOIN (SELECT customerid, country FROM cust) USING (customerid)
WHERE orderdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
GROUP BY ALL"""
ORACLE["orders_by_country_quarter"] = sql(_BY_COUNTRY_Q, "cust", "ord")
ORACLE["orders_quarter_pivot"] = sql(f"""
SELECT country, q1, q2, q3, q4
FROM (PIVOT ({_BY_COUNTRY_Q}) ON cal_quarter IN ('Q1' AS q1, 'Q2' AS q2, 'Q3' AS q3, 'Q4' AS q4)
      USING CAST(sum(no_of_orders) AS BIGINT) GROUP BY country)""", "cust", "ord")
# a customer's orders are counted first, then customers by country
ORACLE["orders_q1_by_country"] = sql("""
, per_customer AS (SELECT customerid, count(*) AS n FROM ord WHERE orderdate >= DATE '1998-01-01' AND orderdate < DATE '1998-04-01' GROUP BY customerid)
SELECT country, CAST(sum(n) AS BIGINT) AS no_of_orders FROM per_customer INNER JOIN cust USING (customerid) GROUP BY country""",
    "cust", "ord")

ORACLE["revenue_month_pivot"] = sql("""
SELECT CAST(year(orderdate) AS BIGINT) AS year_no,
""" + ",\n".join(
    f"       CAST(round(sum(amount) FILTER (WHERE month(orderdate) = {m}), 2) AS DOUBLE) AS m{m}"
    for m in range(1, 7)) + """
FROM (SELECT orderid, sum(gross) AS amount FROM det GROUP BY orderid)
JOIN ord USING (orderid) SEMI JOIN cust USING (customerid)
WHERE year(orderdate) BETWEEN 1996 AND 1998 AND quarter(orderdate) < 3
GROUP BY 1""", "cust", "ord", "det")

ORACLE["dates_of_year"] = sql("SELECT * FROM cal WHERE cal_year = 1998", "cal")
ORACLE["missing_region"] = sql("SELECT customerid FROM cust WHERE region IS NULL", "cust")

# an order is worth its lines, a customer their orders, a country its customers
_WORTH = """
, worth AS (SELECT orderid, sum(net) AS net FROM det GROUP BY orderid),
spent AS (SELECT customerid, {sums} FROM ord INNER JOIN worth USING (orderid) {only} GROUP BY customerid)
"""
_ALL_SPENT = "SELECT country, CAST(round(sum(net), 2) AS DOUBLE) AS revenue FROM spent INNER JOIN cust USING (customerid) GROUP BY country"
ORACLE["revenue_by_country"] = sql(_WORTH.format(sums="sum(net) AS net", only="") + _ALL_SPENT, "cust", "ord", "det")
ORACLE["revenue_by_country_year"] = sql(
    _WORTH.format(sums="sum(net) AS net", only="WHERE orderdate BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'") + _ALL_SPENT, "cust", "ord", "det")
_QUARTERS = "coalesce(sum(net) FILTER (WHERE year(orderdate) = 1997), 0) AS x, coalesce(sum(net) FILTER (WHERE year(orderdate) = 1998), 0) AS y"
ORACLE["revenue_q1_compare"] = sql(
    _WORTH.format(sums=_QUARTERS, only="WHERE quarter(orderdate) = 1 AND year(orderdate) BETWEEN 1997 AND 1998") + f"""
SELECT country, CAST(round(x, 2) AS DOUBLE) AS revenue_x, CAST(round(y, 2) AS DOUBLE) AS revenue_y, CAST(round(y - x, 2) AS DOUBLE) AS difference,
       {rr('CAST((y - x) * 100 AS BIGINT) * 100', 'CAST(x * 100 AS BIGINT)')} AS pct_change
FROM (SELECT country, sum(x) AS x, sum(y) AS y FROM spent INNER JOIN cust USING (customerid) GROUP BY country) t""", "cust", "ord", "det")

ORACLE["date_parts"] = sql("""
SELECT orderdate, CAST(dayofyear(orderdate) AS BIGINT) AS day_of_year,
       CAST(weekofyear(orderdate) AS BIGINT) AS iso_week, CAST(quarter(orderdate) AS BIGINT) AS quarter,
       n_orders, CAST(sum(n_orders) OVER (PARTITION BY isoyear(orderdate), weekofyear(orderdate)) AS BIGINT) AS n_orders_week,
       CAST(sum(n_orders) OVER (PARTITION BY year(orderdate), quarter(orderdate)) AS BIGINT) AS n_orders_quarter
FROM (SELECT orderdate, count(*) AS n_orders FROM ord GROUP BY orderdate)""", "ord")
ORACLE["active_customers"] = sql("SELECT count(DISTINCT customerid) AS active_customers FROM ord", "ord")
ORACLE["order_frequency"] = sql(
    "SELECT customerid, count(*) AS n_orders FROM ord GROUP BY customerid", "ord")
ORACLE["order_frequency_histogram"] = sql("""
SELECT n_orders, count(*) AS n_customers
FROM (SELECT customerid, count(*) AS n_orders FROM ord GROUP BY customerid) x
GROUP BY n_orders""", "ord")

ORACLE["unpopular_products"] = sql("""
SELECT * FROM counted WHERE order_count < (SELECT avg(order_count) FROM counted)""",
                                   "counted", extra={"counted": """
SELECT p.productid, p.productname, p.categoryname, CAST(coalesce(x.n, 0) AS BIGINT) AS order_count
FROM prod p LEFT JOIN (SELECT productid, count(*) AS n FROM det GROUP BY productid) x
  ON p.productid = x.productid"""})

ORACLE["random_customers"] = sql("""
SELECT d.draw, d.customerid, c.companyname
FROM (SELECT r.range AS draw,
             b.lo + (CAST('0x' || substr(md5('cust|' || CAST(r.range AS VARCHAR)), 1, 15) AS BIGINT)
                     % (b.hi - b.lo + 1)) AS customerid
      FROM range(100) r, (SELECT min(customerid) AS lo, max(customerid) AS hi FROM cust) b) d
JOIN cust c ON c.customerid = d.customerid""", "cust")

# --------------------------------------------------------------- calendar
ORACLE["date_dim"] = sql("SELECT * FROM cal", "cal")
ORACLE["date_dim_holidays"] = sql("""
SELECT date_key, cal.cal_date, full_desc, day_week, day_num_month, day_num_year, last_day_ind,
       cal_week_end_date, cal_week_year, month_name, cal_month_year, cal_year_month, cal_quarter,
       cal_year_quarter, cal_year,
       CASE WHEN hol.ev IS NOT NULL THEN 'Y' ELSE 'N' END AS holiday_ind, weekday_ind,
       hol.ev AS festive_event
FROM cal LEFT JOIN hol ON cal.cal_date = hol.cal_date""", "cal", "hol")
ORACLE["mark_holiday"] = sql("""
SELECT * REPLACE (CASE WHEN cal_date = DATE '2001-01-01' THEN 'Y' ELSE holiday_ind END AS holiday_ind,
                  CASE WHEN cal_date = DATE '2001-01-01' THEN 'NEW YEAR' ELSE festive_event END
                    AS festive_event)
FROM cal""", "cal")
ORACLE["academic_year"] = sql("""
SELECT date_key, cal_date,
       CASE WHEN cal_date <= make_date(sy + 1, 4, 25)
            THEN CAST(sy AS VARCHAR) || '/' || lpad(CAST((sy + 1) % 100 AS VARCHAR), 2, '0') END
         AS acad_year
FROM (SELECT *, CASE WHEN month(cal_date) * 100 + day(cal_date) >= 616 THEN year(cal_date)
                     ELSE year(cal_date) - 1 END AS sy FROM cal) x""", "cal")

# ------------------------------------------------------- keys and quality
ORACLE["surrogate_key"] = sql(
    "SELECT rec_no, orderid, productid, suppkey, linenumber FROM recs", "recs")
ORACLE["rekey_customers"] = sql("""
SELECT new_customerid, substr(companyname, 1, 18) || '-' || CAST(new_customerid AS VARCHAR) AS companyname,
       city, region, postalcode, country
FROM (SELECT CAST(row_number() OVER (ORDER BY customerid) + 100000 AS BIGINT) AS new_customerid, *
      FROM cust) x""", "cust")
ORACLE["pk_violations"] = sql("""
SELECT orderid, productid, count(*) AS n_rows FROM det GROUP BY orderid, productid
HAVING count(*) > 1""", "det")
ORACLE["orders_without_lines"] = sql("SELECT orderid, customerid FROM ord ANTI JOIN lines USING (orderid)", "ord", "lines")
ORACLE["fk_violations"] = sql("""
SELECT o.orderid, o.customerid FROM ord o
WHERE o.customerid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cust c WHERE c.customerid = o.customerid)""",
                              "ord", "cust")


def _long_counts(src: str, checks: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS column_name, CAST(count(*) FILTER (WHERE {cond}) AS BIGINT) AS n_violations "
        f"FROM {src}" for name, cond in checks.items())


ORACLE["null_violations"] = sql(_long_counts("cust", {
    c: f"{c} IS NULL" for c in ["customerid", "companyname", "country", "region", "city", "postalcode"]}),
    "cust")
ORACLE["length_violations"] = sql(_long_counts("pj", {
    c: f"length({c}) > {n}" for c, n in {"productname": 40, "quantityperunit": 20, "categoryname": 15,
                                         "sup_companyname": 40, "sup_country": 15,
                                         "sup_city": 15}.items()}),
    "pj", extra={"pj": """SELECT p.*, s.companyname AS sup_companyname, s.country AS sup_country,
                                 s.city AS sup_city
                          FROM prod p LEFT JOIN supp s ON p.supplierid = s.supplierid"""})
ORACLE["key_coverage"] = sql("""
SELECT CAST(min(customerid) AS BIGINT) AS min_id, CAST(max(customerid) AS BIGINT) AS max_id,
       count(customerid) AS n_rows, count(DISTINCT customerid) AS n_distinct FROM ord""", "ord")

# ------------------------------------------------------------ dimensions
ORACLE["clean_customers"] = sql("""
SELECT customerid, companyname, city, coalesce(region, city) AS region,
       coalesce(postalcode, '53300') AS postalcode, country FROM cust""", "cust")
ORACLE["customer_dim"] = sql("SELECT * FROM cd", "cd")
ORACLE["employee_dim"] = sql("SELECT * FROM ed", "ed")
ORACLE["product_dim"] = sql("SELECT * FROM pd", "pd")

# ------------------------------------------------------- de-duplication
_DUP_ORDERS = """SELECT DISTINCT orderid
FROM (SELECT orderid FROM det WHERE productid IS NOT NULL GROUP BY orderid, productid HAVING count(*) > 1)"""
ORACLE["orders_with_duplicates"] = sql(_DUP_ORDERS, "det")
ORACLE["duplicate_candidates"] = sql(f"""
SELECT rec_no, CAST(orderid AS VARCHAR) || '-' || CAST(productid AS VARCHAR) AS order_product
FROM recs WHERE orderid IN ({_DUP_ORDERS})""", "recs", "det")
ORACLE["duplicate_rec_nos"] = sql("""
SELECT rec_no FROM (SELECT rec_no, row_number() OVER (PARTITION BY orderid, productid ORDER BY rec_no) AS rn
                    FROM recs) x WHERE rn > 1""", "recs")
ORACLE["dedup_order_details"] = sql("""
SELECT orderid, productid, CAST(unitprice AS DOUBLE) AS unitprice, quantity, CAST(gross AS DOUBLE) AS gross, CAST(discount AS DOUBLE) AS discount
FROM nd""", "nd")
ORACLE["duplicate_summary"] = sql("""
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_pairs,
       CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT orderid, productid, count(*) AS n FROM det GROUP BY orderid, productid) x""", "det")

# ----------------------------------------------------------------- facts
ORACLE["sales_fact"] = sql("""
SELECT date_key, customer_key, product_key, employee_key, orderid, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(gross_amount AS DOUBLE) AS gross_amount, quantity, CAST(discount AS DOUBLE) AS discount,
       CAST(line_total AS DOUBLE) AS line_total
FROM sf""", "sf")
ORACLE["star_sales"] = sql("""
SELECT country, cal_year, categoryname, CAST(sum(amount) AS DOUBLE) AS total_sales
FROM (SELECT date_key, customer_key, product_key, sum(line_total) AS amount FROM sf GROUP BY ALL)
JOIN (SELECT product_key, categoryname FROM pd WHERE categoryname IN ('PROMO', 'SMALL', 'LARGE')) USING (product_key)
JOIN (SELECT customer_key, country FROM cd WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3')) USING (customer_key)
JOIN (SELECT date_key, cal_year FROM cal WHERE cal_year BETWEEN 1998 AND 2000) USING (date_key)
GROUP BY ALL""", "sf", "cal", "cd", "pd")


# --------------------------------------------------------------- library
_OD = "CASE WHEN coalesce(overduedays, 0) > 0 THEN 1 ELSE 0 END"
_YM = "strftime(loan_date, '%Y-%m')"
_LIB = dict(window_views(REPORT_START, REPORT_END))
_LIB["stf"] = VIEWS["stf"]


def lsql(body: str, *names: str, extra: dict | None = None) -> str:
    views = dict(_LIB)
    if extra:
        views.update(extra)
    return sql(body, *names, extra=views)


def _stats(keys: str, src: str = "loan") -> str:
    return f"""SELECT {keys}, count(*) AS total_loans, CAST(sum({_OD}) AS BIGINT) AS overdue_loans,
       {pct(f'sum({_OD})', 'count(*)')} AS overdue_rate_pct,
       {rr('sum(coalesce(overduedays, 0))', 'count(*)')} AS avg_overdue_days
FROM {src} GROUP BY {keys}"""


# One row per member, month and limit, loans ('L') and successful reservations ('R') one below the other;
# a member counts once for a month however many versions have the limit.
_USE = f"""
SELECT membershiptype, {_YM} AS year_month, 'L' AS kind, memberid, maxbookloan AS cap, count(*) AS n,
       sum(coalesce(loandays, 0)) AS days, sum({_OD}) AS late, sum(coalesce(overduedays, 0)) AS late_days
FROM loan GROUP BY ALL
UNION ALL
SELECT membershiptype, strftime(resv_date, '%Y-%m'), 'R', memberid, maxreservation, count(*), 0, 0, 0
FROM resv JOIN (SELECT member_key, memberid, membershiptype, maxreservation FROM mem) USING (member_key)
WHERE upper(reservationstatus) = 'SUCCESS' GROUP BY ALL"""


def _share_at_cap(kind: str) -> str:
    has = f"kind = '{kind}' AND cap > 0"
    return "coalesce(" + pct(f"count(DISTINCT memberid) FILTER (WHERE {has} AND n >= cap)",
                             f"count(DISTINCT memberid) FILTER (WHERE {has})") + ", 0.0)"


ORACLE["membership_utilisation_month"] = lsql(f"""
SELECT membershiptype, year_month, CAST(sum(n) FILTER (WHERE kind = 'L') AS BIGINT) AS bookloaninmonths,
       {rr('sum(days)', "sum(n) FILTER (WHERE kind = 'L')")} AS avgloandurationdays,
       {_share_at_cap('L')} AS hit_maxbookuti_perc, {_share_at_cap('R')} AS hit_maxresruti_perc,
       CAST(sum(late) AS BIGINT) AS totaloverdue,
       {rr('sum(late_days)', "sum(n) FILTER (WHERE kind = 'L')")} AS avgoverduedays
FROM ({_USE}) GROUP BY membershiptype, year_month
HAVING count(*) FILTER (WHERE kind = 'L') > 0""", "loan", "resv", "mem")

ORACLE["overdue_month"] = lsql(
    f"SELECT * FROM ({_stats('year_month', f'(SELECT *, {_YM} AS year_month FROM loan) x')}) y", "loan")

_AGE = "CAST(datesub('month', dob, DATE '2000-06-30') // 12 AS BIGINT)"
_BAND = """CASE WHEN age IS NULL THEN 'Unknown' WHEN age < 18 THEN '<18'
     WHEN age BETWEEN 18 AND 25 THEN '18-25' WHEN age BETWEEN 26 AND 40 THEN '26-40'
     WHEN age BETWEEN 41 AND 60 THEN '41-60' ELSE '60+' END"""
# one row per member with activity; a repeat offender has three loans or more, half of them or more late
_PER_MEMBER = f"""
SELECT {_BAND} AS age_band, membershiptype, n, late, late_days, n >= 3 AND 2 * late >= n AS again
FROM (SELECT memberid, membershiptype, {_AGE} AS age, count(*) AS n, sum({_OD}) AS late,
             sum(coalesce(overduedays, 0)) AS late_days
      FROM loan GROUP BY ALL)"""
_MEMBER_COLUMNS = f"""count(*) AS members_with_activity, count(*) FILTER (WHERE again) AS repeat_offenders,
       {pct('count(*) FILTER (WHERE again)', 'count(*)')} AS repeat_offender_rate_pct
FROM ({_PER_MEMBER}) GROUP BY age_band, membershiptype"""
ORACLE["repeat_offenders"] = lsql(f"SELECT age_band, membershiptype, {_MEMBER_COLUMNS}", "loan")
ORACLE["overdue_member_behaviour"] = lsql(f"""
SELECT age_band, membershiptype, CAST(sum(n) AS BIGINT) AS total_loans, CAST(sum(late) AS BIGINT) AS overdue_loans,
       {pct('sum(late)', 'sum(n)')} AS overdue_rate_pct, {rr('sum(late_days)', 'sum(n)')} AS avg_overdue_days,
       {_MEMBER_COLUMNS}""", "loan")

# records per paid staff member, and the place of records per salary between the lowest and the highest
_LOAD = """
SELECT staffid, salary, count(done) AS total_records,
       CASE WHEN salary > 0 THEN CAST(count(done) AS DOUBLE) / CAST(salary AS DOUBLE) END AS wps
FROM stf LEFT JOIN (SELECT staff_key, true AS done FROM loan UNION ALL SELECT staff_key, true FROM resv)
     USING (staff_key)
WHERE salary IS NOT NULL GROUP BY staff_key, staffid, salary"""
_BUCKET = f"""
SELECT CASE WHEN hi > lo AND w >= lo + 0.8 * (hi - lo) THEN 'Top20'
            WHEN hi > lo AND w < lo + 0.2 * (hi - lo) THEN 'Underperformance20' ELSE 'Qualified60' END AS category,
       CAST(sum(total_records) AS BIGINT) AS total_records, count(*) AS num_staff, sum(salary) AS total_salary
FROM (SELECT *, min(w) OVER () AS lo, max(w) OVER () AS hi FROM (SELECT *, coalesce(wps, 0.0) AS w FROM ({_LOAD})))
GROUP BY category"""
ORACLE["staff_workload"] = lsql(
    f"SELECT staffid, CAST(salary AS DOUBLE) AS salary, total_records, wps FROM ({_LOAD})",
    "stf", "loan", "resv")
ORACLE["staff_buckets"] = lsql(f"""
SELECT category, total_records, num_staff, CAST(total_salary AS DOUBLE) AS total_salary
FROM ({_BUCKET})""", "stf", "loan", "resv")
ORACLE["staff_report"] = lsql(f"""
SELECT category, total_records AS number_of_records, num_staff AS number_of_staff,
       CAST(total_salary AS DOUBLE) AS total_salary_expenses,
       {rr('total_salary * 100', 'total_records * 100')} AS workload_salary
FROM ({_BUCKET})""", "stf", "loan", "resv")

_QTR = "CAST(year(loan_date) AS VARCHAR) || '-Q' || CAST(quarter(loan_date) AS VARCHAR)"
ORACLE["overdue_by_period"] = lsql(
    _stats("period, membershiptype", f"(SELECT *, {_QTR} AS period FROM loan) x"), "loan")
ORACLE["overdue_peak"] = lsql(
    _stats("period", f"(SELECT *, {_YM} AS period FROM loan) x")
    + " ORDER BY overdue_rate_pct DESC, overdue_loans DESC, period LIMIT 1", "loan")
ORACLE["overdue_by_region"] = lsql(_stats("region"), "loan")
ORACLE["overdue_by_category"] = lsql(
    _stats("category", "(SELECT l.*, t.category FROM loan l JOIN titles t ON l.booktitle_key = t.booktitle_key) x"),
    "loan", "titles")
_DURATION = f"""
SELECT membershiptype, {{period}} AS period, count(*) AS total_loans, CAST(sum({_OD}) AS BIGINT) AS overdue_loans,
       {pct(f'sum({_OD})', 'count(*)')} AS overdue_rate_pct,
       {rr('sum(coalesce(overduedays, 0))', 'count(*)')} AS avg_overdue_days,
       {rr('sum(loanduration)', 'count(*)')} AS avg_loan_duration
FROM loan GROUP BY ALL"""
ORACLE["duration_vs_overdue"] = lsql(_DURATION.format(period=_QTR), "loan")
ORACLE["duration_vs_overdue_month"] = lsql(_DURATION.format(period=_YM), "loan")
ORACLE["duration_vs_overdue_year"] = lsql(_DURATION.format(period="CAST(year(loan_date) AS VARCHAR)"), "loan")
ORACLE["overdue_above_average"] = lsql(f"""
SELECT t.*, {pct('a.od', 'a.n')} AS overall_rate_pct
FROM ({_stats('membershiptype')}) t,
     (SELECT count(*) AS n, sum({_OD}) AS od FROM loan) a
WHERE t.overdue_loans * a.n > a.od * t.total_loans""", "loan")

# what members do in a month, by kind, against the limit of that kind
_MONTHS = f"""
SELECT 'loan' AS kind, membershiptype, memberid, {_YM} AS ym, maxbookloan AS most, count(*) AS n
FROM loan GROUP BY ALL
UNION ALL
SELECT 'reservation', membershiptype, memberid, strftime(resv_date, '%Y-%m'), maxreservation, count(*)
FROM resv JOIN mem USING (member_key) WHERE reservationstatus ILIKE 'success' GROUP BY ALL"""
ORACLE["avg_utilisation"] = lsql(f"""
SELECT membershiptype, CAST(coalesce(lm, 0) AS BIGINT) AS loan_member_months, {rr('ln', 'lm')} AS avg_monthly_loans,
       {rr('ll', 'lm')} AS avg_loan_limit, {pct('ln', 'll')} AS loan_utilisation_pct,
       CAST(coalesce(rm, 0) AS BIGINT) AS resv_member_months, {rr('rn', 'rm')} AS avg_monthly_resvs,
       {rr('rl', 'rm')} AS avg_resv_limit, {pct('rn', 'rl')} AS resv_utilisation_pct
FROM (SELECT membershiptype, nullif(count(*) FILTER (kind = 'loan'), 0) AS lm, sum(n) FILTER (kind = 'loan') AS ln,
             sum(most) FILTER (kind = 'loan') AS ll, nullif(count(*) FILTER (kind = 'reservation'), 0) AS rm,
             sum(n) FILTER (kind = 'reservation') AS rn, sum(most) FILTER (kind = 'reservation') AS rl
      FROM ({_MONTHS}) GROUP BY membershiptype)""", "loan", "resv", "mem")
ORACLE["high_utilisation_members"] = lsql(f"""
SELECT membershiptype, kind, count(*) AS member_months_over, count(DISTINCT memberid) AS members_over
FROM ({_MONTHS}) WHERE most > 0 AND n / most > 0.9 GROUP BY membershiptype, kind""", "loan", "resv", "mem")

_N_MONTHS = (REPORT_END.year - REPORT_START.year) * 12 + REPORT_END.month - REPORT_START.month + 1
_STAFF_TOTAL = """SELECT s.staffid, CAST(coalesce(l.loans, 0) + coalesce(r.resvs, 0) AS BIGINT) AS total_records
FROM stf s
LEFT JOIN (SELECT staff_key, count(*) AS loans FROM loan GROUP BY staff_key) l ON l.staff_key = s.staff_key
LEFT JOIN (SELECT staff_key, count(*) AS resvs FROM resv GROUP BY staff_key) r ON r.staff_key = s.staff_key"""
ORACLE["staff_month_average"] = lsql(f"""
SELECT staffid, total_records, {rr('total_records', str(_N_MONTHS))} AS avg_monthly_records
FROM ({_STAFF_TOTAL}) t""", "stf", "loan", "resv")
ORACLE["staff_top3"] = lsql(f"""
SELECT staffid, total_records FROM ({_STAFF_TOTAL}) t
ORDER BY total_records DESC, staffid LIMIT 3""", "stf", "loan", "resv",
                           extra=window_views(PAST_YEAR_START, REPORT_END))
def _under_views(start, end) -> dict:
    w = window_views(start, end)
    return {
        "loan": w["loan"], "resv": w["resv"],
        "months": f"""SELECT strftime(CAST(d AS DATE), '%Y-%m') AS year_month
                      FROM generate_series(TIMESTAMP '{start.isoformat()}',
                                           TIMESTAMP '{end.replace(day=1).isoformat()}',
                                           INTERVAL 1 MONTH) t(d)""",
        "sm": f"""SELECT staff_key, ym AS year_month, count(*) AS n
                  FROM (SELECT staff_key, {_YM} AS ym FROM loan
                        UNION ALL SELECT staff_key, strftime(resv_date, '%Y-%m') AS ym FROM resv) u
                  GROUP BY 1, 2""",
        "tot": "SELECT year_month, sum(n) AS tot FROM sm GROUP BY year_month",
        "ns": "SELECT count(*) AS n_staff FROM stf",
        "grid": """SELECT s.staffid, m.year_month, coalesce(sm.n, 0) AS n, coalesce(tot.tot, 0) AS tot
                   FROM stf s CROSS JOIN months m
                   LEFT JOIN sm ON sm.staff_key = s.staff_key AND sm.year_month = m.year_month
                   LEFT JOIN tot ON tot.year_month = m.year_month""",
    }


EXTRA_DEPS.update({"sm": ["loan", "resv"], "tot": ["sm"], "ns": ["stf"],
                   "grid": ["stf", "months", "sm", "tot"]})


def _under_sql(start, end) -> str:
    n = (end.year - start.year) * 12 + end.month - start.month + 1
    return lsql(f"""
SELECT staffid, months_below, CAST({n} AS BIGINT) AS n_months
FROM (SELECT g.staffid, CAST(count(*) FILTER (WHERE g.n * ns.n_staff < g.tot) AS BIGINT) AS months_below
      FROM grid g, ns GROUP BY g.staffid) x
WHERE months_below * 2 > {n}""", "grid", "ns", extra=_under_views(start, end))


ORACLE["staff_underperforming"] = _under_sql(REPORT_START, REPORT_END)
ORACLE["staff_underperforming_quarter"] = _under_sql(PAST_QUARTER_START, REPORT_END)
ORACLE["staff_underperforming_year"] = _under_sql(PAST_YEAR_START, REPORT_END)
ORACLE["reservation_processing"] = lsql(f"""
SELECT reservationstatus, count(*) AS n_reservations,
       {rr('sum(reservetoreadydays)', 'count(reservetoreadydays)')} AS avg_reserve_to_ready_days,
       {rr('sum(readytosuccessdays)', 'count(readytosuccessdays)')} AS avg_ready_to_success_days,
       {rr('sum(totaldays)', 'count(totaldays)')} AS avg_total_days
FROM resv GROUP BY reservationstatus""", "resv")
ORACLE["staff_member_interactions"] = lsql("""
SELECT staffid, count(DISTINCT memberid) AS n_members
FROM (SELECT staff_key, member_key FROM loan UNION SELECT staff_key, member_key FROM resv)
JOIN (SELECT staff_key, staffid FROM stf) USING (staff_key)
JOIN (SELECT member_key, memberid FROM mem) USING (member_key)
GROUP BY staffid""", "loan", "resv", "stf", "mem")


# ------------------------------------------------------------ generators
def hr(salt: str, lo, hi, *keys: str) -> str:
    """Twin of ``hash_random``: lo + md5-derived integer mod (hi - lo)."""
    parts = " || '|' || ".join([f"'{salt}'"] + [f"CAST({k} AS VARCHAR)" for k in keys])
    h = f"CAST('0x' || substr(md5({parts}), 1, 15) AS BIGINT)"
    return f"({lo} + {h} % ({hi} - ({lo})))"


_GEN = {
    "rep": """SELECT CAST(100001 + (k - 1) * 64 + copy AS BIGINT) AS new_customerid,
                 substr(companyname, 1, 18) || '-' || CAST(100001 + (k - 1) * 64 + copy AS VARCHAR)
                   AS companyname, city, region, postalcode, country
              FROM (SELECT row_number() OVER (ORDER BY customerid) AS k, * FROM cust) c,
                   range(0, 64) r(copy)""",
    "gbounds": """SELECT CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e
                  FROM orders""",
    "gdays": f"""SELECT orderdate, {hr('orders_per_day', 10, 51, 'orderdate')} AS n
                 FROM (SELECT CAST(unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP),
                                                          INTERVAL 1 DAY)) AS DATE) AS orderdate
                       FROM gbounds) d""",
    "gord": f"""SELECT CAST(row_number() OVER (ORDER BY orderdate, i) + 100000 AS BIGINT) AS orderid,
                   CAST(r.lo + CAST('0x' || substr(md5('customer|' || CAST(orderdate AS VARCHAR) || '|'
                        || CAST(i AS VARCHAR)), 1, 15) AS BIGINT) % (r.hi - r.lo + 1) AS BIGINT) AS customerid,
                   CAST({hr('employee', 1, 10, 'orderdate', 'i')} AS BIGINT) AS employeeid,
                   orderdate, orderdate + 7 AS requireddate, orderdate + 3 AS shippeddate,
                   CAST({hr('shipper', 1, 7, 'orderdate', 'i')} AS BIGINT) AS shipvia,
                   CAST(CAST({hr('freight', 599, 10000, 'orderdate', 'i')} AS DECIMAL(8,0)) / 100
                        AS DECIMAL(6,2)) AS freight
                FROM (SELECT orderdate, unnest(range(1, n + 1)) AS i FROM gdays) g,
                     (SELECT min(new_customerid) AS lo, max(new_customerid) AS hi FROM rep) r""",
    "glines": f"""SELECT x.*, p.unitprice FROM (
                     SELECT orderid, ctr,
                            CAST(pr.plo + CAST('0x' || substr(md5('product|' || CAST(orderid AS VARCHAR) || '|'
                                 || CAST(ctr AS VARCHAR)), 1, 15) AS BIGINT) % (pr.phi - pr.plo + 1) AS BIGINT)
                              AS productid,
                            CAST({hr('quantity', 1, 11, 'orderid', 'ctr')} AS BIGINT) AS quantity,
                            CAST(CAST({hr('discount', 5, 71, 'orderid', 'ctr')} AS DECIMAL(8,0)) / 100
                                 AS DECIMAL(3,2)) AS discount
                     FROM (SELECT orderid, unnest(range(1, {hr('lines_per_order', 1, 6, 'orderid')} + 1)) AS ctr
                           FROM gord) l,
                          (SELECT min(productid) AS plo, max(productid) AS phi FROM prod) pr) x
                  JOIN prod p ON p.productid = x.productid""",
}
EXTRA_DEPS.update({"rep": ["cust"], "gdays": ["gbounds"], "gord": ["gdays", "rep"],
                   "glines": ["gord", "prod"]})

ORACLE["replicate_customers"] = sql("SELECT * FROM rep", "rep", extra=_GEN)
ORACLE["generate_orders"] = sql(
    "SELECT * REPLACE (CAST(freight AS DOUBLE) AS freight) FROM gord", "gord", extra=_GEN)
ORACLE["generate_order_details"] = sql("""
SELECT CAST(row_number() OVER (ORDER BY orderid, ctr) AS BIGINT) AS rec_no, orderid, productid,
       CAST(unitprice AS DOUBLE) AS unitprice, quantity, CAST(discount AS DOUBLE) AS discount
FROM glines""", "glines", extra=_GEN)

# ------------------------------------------------- enrollment and type 2
_ENR = {
    "stud": """SELECT CAST(row_number() OVER (ORDER BY c.c_custkey) + 1233 AS BIGINT) AS s_key,
                  c.c_custkey AS s_id
               FROM customer c JOIN nr ON c.c_nationkey = nr.n_nationkey""",
    "cbase": """SELECT p_partkey AS course_id, p_name AS course_title, p_type AS faculty_name,
                   CAST(p_size AS BIGINT) AS max_capacity,
                   CAST(p_retailprice AS DECIMAL(12,2)) AS fee_per_credit,
                   CAST(p_size % 4 + 1 AS BIGINT) AS credit_hour FROM part""",
    "cver": """SELECT *, 0 AS version, DATE '1900-01-01' AS effective_start_date,
                  DATE '9999-12-31' AS effective_end_date FROM cbase WHERE course_id % 5 <> 0
               UNION ALL
               SELECT *, 1, DATE '1900-01-01', DATE '1997-12-31' FROM cbase WHERE course_id % 5 = 0
               UNION ALL
               SELECT *, 2, DATE '1998-01-01', DATE '9999-12-31' FROM cbase WHERE course_id % 5 = 0""",
    "cdim": """SELECT CAST(row_number() OVER (ORDER BY course_id, effective_start_date) + 1233 AS BIGINT)
                  AS course_key, * FROM cver""",
    "enr": """SELECT l.l_orderkey AS se_id, o.o_custkey AS s_id, l.l_partkey AS course_id,
                 l.l_linenumber AS linenumber, l.l_suppkey AS suppkey,
                 CAST(l.l_shipdate AS DATE) AS register_date, l.l_returnflag AS grade
              FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
}
EXTRA_DEPS.update({"stud": ["nr"], "cver": ["cbase"], "cdim": ["cver"]})
_ENR_SELECT = """
SELECT s_key, course_key, year(register_date) * 10000 + month(register_date) * 100 + day(register_date) AS date_key,
       se_id, register_date, grade, CAST(fee_per_credit AS DOUBLE) AS fee_per_credit, credit_hour,
       CAST(CAST(fee_per_credit * credit_hour AS DECIMAL(18,2)) AS DOUBLE) AS total_fees
FROM enr SEMI JOIN cal ON cal_date = register_date
JOIN (SELECT s_id, s_key FROM stud) USING (s_id) JOIN cdim USING (course_id) {cond}"""
ORACLE["enrollment_fact"] = sql(_ENR_SELECT.format(
    cond="WHERE register_date BETWEEN effective_start_date AND effective_end_date"),
    "enr", "stud", "cdim", "cal", extra=_ENR)
ORACLE["enrollment_fact_literal"] = sql(_ENR_SELECT.format(cond=""), "enr", "stud", "cdim", "cal",
                                        extra=_ENR)
ORACLE["scd2_lookup"] = sql("""
SELECT e.se_id, e.linenumber, e.suppkey, e.course_id, e.register_date, c.version
FROM enr e JOIN cver c ON c.course_id = e.course_id
 AND e.register_date BETWEEN c.effective_start_date AND c.effective_end_date""", "enr", "cver", extra=_ENR)
ORACLE["scd2_apply"] = sql("""
WITH first AS (SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS sk, p_partkey AS course_id,
                      p_name AS course_title FROM part),
     snap AS (SELECT p_partkey AS course_id,
                     CASE WHEN p_partkey % 5 = 0 THEN upper(p_name) ELSE p_name END AS course_title FROM part),
     chg AS (SELECT f.sk, f.course_id, f.course_title AS old_title, s.course_title AS new_title
             FROM first f JOIN snap s ON f.course_id = s.course_id
             WHERE f.course_title IS DISTINCT FROM s.course_title)
SELECT sk, course_id, course_title, DATE '1900-01-01' AS effective_start_date,
       CASE WHEN course_id IN (SELECT course_id FROM chg) THEN DATE '1997-12-31' ELSE DATE '9999-12-31' END
         AS effective_end_date,
       CASE WHEN course_id IN (SELECT course_id FROM chg) THEN 'N' ELSE 'Y' END AS current_flag
FROM first
UNION ALL
SELECT CAST((SELECT max(sk) FROM first) + row_number() OVER (ORDER BY course_id) AS BIGINT) AS sk,
       course_id, new_title AS course_title, DATE '1998-01-01', DATE '9999-12-31', 'Y'
FROM chg""")

ORACLE["overdue_by_year"] = lsql(
    _stats("period, membershiptype", "(SELECT *, CAST(year(loan_date) AS VARCHAR) AS period FROM loan) x"),
    "loan")
ORACLE["overdue_by_event"] = lsql(_stats("period", """(
    SELECT loan.*, rules.festive_event AS period FROM loan
    JOIN rules ON month(loan_date) = h_month AND day(loan_date) = h_day)"""), "loan", "rules")
ORACLE["academic_year_windows"] = sql("""
SELECT date_key, cal_date, CASE WHEN cal_date < DATE '1997-06-16' OR cal_date > DATE '1999-04-24' THEN 'none'
                                WHEN cal_date <= DATE '1998-04-25' THEN '1997/98'
                                WHEN cal_date >= DATE '1998-06-29' THEN '1998/99' ELSE 'none' END AS acad_year
FROM cal""", "cal")
ORACLE["overdue_by_holiday"] = lsql(_stats("period", """(
    SELECT l.*, CASE WHEN h.ev IS NOT NULL THEN 'Y' ELSE 'N' END AS period
    FROM loan l LEFT JOIN hol h ON h.cal_date = l.loan_date) x"""), "loan", "hol")
ORACLE["overdue_by_academic_year"] = lsql(_stats("period", """(
    SELECT *, CASE WHEN loan_date <= make_date(sy + 1, 4, 25)
                   THEN CAST(sy AS VARCHAR) || '/' || lpad(CAST((sy + 1) % 100 AS VARCHAR), 2, '0') END AS period
    FROM (SELECT *, CASE WHEN month(loan_date) * 100 + day(loan_date) >= 616 THEN year(loan_date)
                         ELSE year(loan_date) - 1 END AS sy FROM loan) a) x"""), "loan")

ORACLE["delete_duplicates"] = sql("""
SELECT rec_no, orderid, productid, quantity, l_discount AS discount
FROM recs WHERE rec_no NOT IN (
  SELECT rec_no FROM (SELECT rec_no, row_number() OVER (PARTITION BY orderid, productid ORDER BY rec_no) AS rn
                      FROM recs) x WHERE rn > 1)""", "recs")

ORACLE["scd2_merge_lookup"] = ORACLE["scd2_lookup"]
# every touched key's days in order: what holds from each of them on, runs of equal values as one
ORACLE["scd2_changes"] = sql("""
, dim AS (SELECT CAST(row_number() OVER (ORDER BY course_id, effective_start_date) AS BIGINT) AS sk, course_id,
                 CASE WHEN version = 2 THEN upper(course_title) ELSE course_title END AS title,
                 effective_start_date AS f, effective_end_date AS t FROM cver),
log AS (SELECT course_id + CASE WHEN se_id % 50 = 0 THEN 1000000000 ELSE 0 END AS course_id, register_date AS d, se_id * 8 + linenumber AS seq,
               CASE WHEN grade = 'R' AND se_id % 4 = 0 THEN NULL ELSE 'Edition ' || se_id % 3 END AS title FROM enr),
last AS (SELECT course_id, d, arg_max(coalesce(title, chr(0)), seq) AS title FROM log GROUP BY ALL),
known AS (SELECT * FROM dim WHERE course_id IN (SELECT course_id FROM log)),
days AS (SELECT course_id, d FROM last UNION SELECT course_id, f FROM known UNION SELECT course_id, t + 1 FROM known WHERE t < DATE '9999-12-31'),
state AS (
  SELECT days.course_id, days.d, k.sk, CASE WHEN l.title IS NOT NULL THEN nullif(l.title, chr(0)) ELSE k.title END AS title
  FROM days LEFT JOIN last l ON l.course_id = days.course_id AND l.d = days.d LEFT JOIN known k ON k.course_id = days.course_id AND k.f = days.d),
steps AS (SELECT * FROM state QUALIFY title IS DISTINCT FROM lag(title) OVER (PARTITION BY course_id ORDER BY d)),
spans AS (SELECT *, lead(d) OVER (PARTITION BY course_id ORDER BY d) AS nd FROM steps),
found AS (SELECT sk, course_id, title, d AS f, coalesce(CAST(nd - 1 AS DATE), DATE '9999-12-31') AS t FROM spans WHERE title IS NOT NULL),
numbered AS (
  SELECT sk, course_id, title, f, t FROM found WHERE sk IS NOT NULL
  UNION ALL SELECT * FROM dim WHERE course_id NOT IN (SELECT course_id FROM log)
  UNION ALL SELECT CAST((SELECT max(sk) FROM dim) + row_number() OVER (ORDER BY course_id, f) AS BIGINT), course_id, title, f, t FROM found WHERE sk IS NULL)
SELECT sk, course_id, title AS course_title, f AS effective_start_date, t AS effective_end_date,
       CASE WHEN t = DATE '9999-12-31' THEN 'Y' ELSE 'N' END AS current_flag FROM numbered""", "enr", "cver", extra=_ENR)

ORACLE["running_totals"] = sql(f"""
SELECT row_number() OVER w AS rec_no, orderid, productid, suppkey, linenumber,
       CAST(sum(quantity) OVER w AS BIGINT) AS total_quantity,
       CAST(sum(CAST(round(gross * (1 - discount), 2) AS DECIMAL(18,2))) OVER w AS DOUBLE) AS total_net
FROM lines WINDOW w AS (ORDER BY {_LINE_ORDER_SQL} ROWS UNBOUNDED PRECEDING)""", "lines")
ORACLE["previous_line"] = sql(f"""
SELECT row_number() OVER w AS rec_no, orderid, productid, suppkey, linenumber, lag(orderid) OVER w AS prev_orderid,
       lag(productid) OVER w AS prev_productid,
       CASE WHEN (orderid, productid) = (lag(orderid) OVER w, lag(productid) OVER w) THEN 'Y' ELSE 'N' END AS repeated
FROM lines WINDOW w AS (ORDER BY {_LINE_ORDER_SQL})""", "lines")
ORACLE["customer_running_spend"] = sql("""
SELECT customerid, orderid, orderdate, row_number() OVER w AS order_no, CAST(sum(net) OVER w AS DOUBLE) AS spent,
       orderdate - lag(orderdate) OVER w AS days_since
FROM ord JOIN (SELECT orderid, sum(net) AS net FROM det GROUP BY 1) USING (orderid)
WINDOW w AS (PARTITION BY customerid ORDER BY orderdate, orderid ROWS UNBOUNDED PRECEDING)""", "ord", "det")

ORACLE["key_map"] = sql("""
, old AS (SELECT DISTINCT customerid FROM ord WHERE orderdate <= DATE '1995-06-30')
SELECT customerid, load, CAST(1233 + row_number() OVER (ORDER BY load, customerid) AS BIGINT) AS customer_key
FROM (SELECT customerid, CAST(1 AS BIGINT) AS load FROM old
      UNION ALL SELECT customerid, 2 FROM cust WHERE customerid NOT IN (SELECT customerid FROM old))""", "ord", "cust")
ORACLE["load_gate"] = sql(f"""
SELECT orderid, productid, suppkey, linenumber, concat_ws(', ',
    CASE WHEN discount <= 0 THEN 'discount' END, CASE WHEN orderdate <= DATE '1995-12-31' THEN 'key:exists' END,
    CASE WHEN row_number() OVER (PARTITION BY orderid, productid ORDER BY {_LINE_ORDER_SQL}) > 1 THEN 'key:repeated' END,
    CASE WHEN orderdate > DATE '2000-12-31' THEN 'parent:order' END, CASE WHEN quantity > 48 THEN 'quantity' END) AS broken_rules
FROM lines JOIN ord USING (orderid)""", "lines", "ord")

ORACLE["key_islands"] = sql("""
SELECT min(customerid) AS low_id, max(customerid) AS high_id, count(*) AS n_ids, min(n) - 1 AS ids_before
FROM (SELECT customerid, row_number() OVER (ORDER BY customerid) AS n FROM (SELECT DISTINCT customerid FROM ord)) GROUP BY customerid - n""", "ord")
ORACLE["active_customer_draws"] = sql("""
SELECT orderid, rank, a.customerid
FROM (SELECT orderid, CAST('0x' || substr(md5('active|' || CAST(orderid AS VARCHAR)), 1, 15) AS BIGINT) % (SELECT count(DISTINCT customerid) FROM ord) AS rank FROM ord) d
JOIN (SELECT customerid, row_number() OVER (ORDER BY customerid) - 1 AS n FROM (SELECT DISTINCT customerid FROM ord)) a ON a.n = d.rank""", "ord")
ORACLE["rewrite_partitions"] = sql("""
, m AS (SELECT orderid, customerid, orderdate, strftime(orderdate, '%Y-%m') AS ym FROM ord)
SELECT orderid, CASE ym WHEN '1997-03' THEN customerid + 1 WHEN '1998-02' THEN 0 ELSE customerid END AS customerid, orderdate, year(orderdate) AS order_year
FROM m WHERE ym <> '1999-01'
UNION ALL SELECT orderid + 1000000000, customerid, orderdate, year(orderdate) FROM m WHERE ym = '1997-03'""", "ord")

_REGIONAL = ", ".join("({}, {}, {}, '{}')".format("NULL" if r is None else f"'{r}'", m, d, _q(e)) for r, m, d, e in REGIONAL_RULES)
_KEPT = {"kept": f"""SELECT r.region, t.m, t.d, substr(t.ev, 1, 25) AS ev
                     FROM (VALUES {_REGIONAL}) t(region, m, d, ev)
                     JOIN (SELECT DISTINCT region FROM (VALUES {_REGIONAL}) u(region, m, d, ev) WHERE region IS NOT NULL) r
                       ON t.region IS NULL OR t.region = r.region"""}
ORACLE["overdue_by_regional_holiday"] = lsql(_stats("region, holiday", """(
    SELECT loan.* REPLACE (coalesce(region, 'Unknown') AS region),
           CASE WHEN EXISTS (SELECT 1 FROM kept k WHERE k.region = loan.region AND k.m = month(loan_date) AND k.d = day(loan_date))
                THEN 'Y' ELSE 'N' END AS holiday
    FROM loan) x"""), "loan", "kept", extra=_KEPT)
ORACLE["overdue_by_regional_event"] = lsql(_stats("region, festive_event", """(
    SELECT loan.*, k.ev AS festive_event FROM loan JOIN kept k ON k.region = loan.region AND k.m = month(loan_date) AND k.d = day(loan_date)) x"""),
    "loan", "kept", extra=_KEPT)
ORACLE["avg_utilisation_rollup"] = ORACLE["avg_utilisation"]
ORACLE["active_members_quarter"] = lsql("""
SELECT period, kind, membershiptype, count(DISTINCT (memberid, most)) AS active_members, count(*) AS records
FROM (SELECT year(loan_date) || '-Q' || quarter(loan_date) AS period, 'loan' AS kind, membershiptype, memberid, maxbookloan AS most FROM loan
      UNION ALL
      SELECT year(resv_date) || '-Q' || quarter(resv_date), 'reservation', m.membershiptype, m.memberid, m.maxreservation
      FROM resv JOIN mem m USING (member_key) WHERE upper(reservationstatus) = 'SUCCESS')
GROUP BY ALL""", "loan", "resv", "mem")
