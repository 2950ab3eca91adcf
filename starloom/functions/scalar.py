"""Scalar helpers that keep the source dialect's meaning on Spark.

Each helper returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def concat_nullsafe(*cols) -> Column:
    """``a || b`` where NULL behaves as the empty string (plain ``concat``
    would return NULL)."""
    return F.concat_ws("", *[_c(c) for c in cols])


def money(c, precision: int = 18, scale: int = 2) -> Column:
    """Exact decimal money; cast before any arithmetic or sum."""
    return _c(c).cast(f"decimal({precision},{scale})")


def net_amount(gross, discount) -> Column:
    """Net line amount ``gross * (1 - discount)`` stored with 2 decimals."""
    return F.round(_c(gross) * (F.lit(1) - _c(discount)), 2).cast("decimal(18,2)")


def to_double_money(c) -> Column:
    """Report output: the exact decimal value rounded to cents as DOUBLE."""
    return F.round(_c(c), 2).cast("double")


def year_month(d) -> Column:
    """``TO_CHAR(d, 'YYYY-MM')``; sorts like the numeric year*100+month."""
    return F.date_format(_c(d), "yyyy-MM")


def age_years(ref_date: _dt.date, dob) -> Column:
    """``TRUNC(MONTHS_BETWEEN(ref, dob) / 12)``: whole years, NULL for NULL dob."""
    # cast truncates toward zero, as TRUNC does
    return (F.months_between(F.lit(ref_date), _c(dob)) / 12).cast("bigint")


# Age bands of the overdue report (label, lowest age, highest
# age; None = open end), and the label of a missing birth date
AGE_BANDS = [("<18", None, 17), ("18-25", 18, 25), ("26-40", 26, 40), ("41-60", 41, 60),
             ("60+", 61, None)]
UNKNOWN_AGE_BAND = "Unknown"


def age_band(age) -> Column:
    """Age band label; 'Unknown' when the age is NULL."""
    a = _c(age)
    expr = F.when(a.isNull(), UNKNOWN_AGE_BAND)
    for label, lo, hi in AGE_BANDS[:-1]:
        expr = expr.when(a <= hi if lo is None else a.between(lo, hi), label)
    return expr.otherwise(AGE_BANDS[-1][0])


def hash_int(salt: str, *keys) -> Column:
    """Deterministic 60-bit unsigned integer from ``md5(salt || '|' || keys)``.

    Unlike ``rand()`` it does not depend on partitioning or task order, so a
    recomputed partition yields the same values; DuckDB computes the same
    number with ``('0x' || substr(md5(..), 1, 15))::BIGINT``.
    """
    parts = [F.lit(salt)] + [_c(k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_random(salt: str, lo: int, hi: int, *keys) -> Column:
    """``TRUNC(DBMS_RANDOM.VALUE(lo, hi))``: an integer in ``[lo, hi)``."""
    return (F.lit(lo) + F.pmod(hash_int(salt, *keys), F.lit(hi - lo))).cast("bigint")


def round_ratio(num, den, scale: int = 2) -> Column:
    """``ROUND(num / den, scale)`` for integer ``num`` and positive integer
    ``den``, rounding half away from zero in exact integer arithmetic (as
    the source's NUMBER type does); DOUBLE; NULL when ``den`` is 0 or NULL.

    SQL twin: ``sign(num) * ((abs(num) * 2 * 10^scale + den) // (2 * den)) / 10^scale``.
    """
    n = _c(num).cast("bigint")
    d = F.nullif(_c(den).cast("bigint"), F.lit(0)).cast("decimal(19,0)")
    f = 10 ** scale
    # wide decimals and integer division: no rounding on the way, no overflow
    q = F.abs(n).cast("decimal(19,0)") * F.lit(2 * f).cast("decimal(12,0)") + d
    whole = F.call_function("div", q, d * F.lit(2).cast("decimal(1,0)"))
    return (F.signum(n) * whole / F.lit(float(f))).cast("double")


def avg_round(total, count, scale: int = 2) -> Column:
    """``ROUND(AVG(x), scale)`` from an integer sum and a row count."""
    return round_ratio(total, count, scale)


def pct_round(part, whole, scale: int = 2) -> Column:
    """``ROUND(part * 100.0 / NULLIF(whole, 0), scale)`` for integer counts."""
    return round_ratio(_c(part).cast("bigint") * 100, whole, scale)


def scalar_row(df, **aggs) -> dict:
    """Several aggregates of ``df`` as ONE scalar subquery (a struct),
    evaluated once; returns ``{name: Column}`` for use in expressions."""
    st = df.agg(F.struct(*[a.alias(k) for k, a in aggs.items()]).alias("_s")).scalar()
    return {k: st.getField(k) for k in aggs}
