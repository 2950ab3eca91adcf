"""Order-insensitive comparison of a Spark result with a DuckDB result."""

import datetime as dt
import decimal
import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def normalised(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    names = [cols[i] for i in order]
    data = sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=_key)
    return names, data


# Spark simple type name -> DuckDB type name of the same column
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN"}


def assert_same(sdf, con, sql):
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    ocols, otypes = rel.columns, [str(t) for t in rel.types]
    orows = rel.fetchall()
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema}
    assert stypes == dict(zip(ocols, otypes)), f"types differ: {stypes} vs {dict(zip(ocols, otypes))}"
    sn, sd = normalised(sdf.columns, srows)
    on, od = normalised(ocols, orows)
    assert sn == on, f"columns differ: {sn} vs {on}"
    assert len(sd) == len(od), f"row counts differ: {len(sd)} vs {len(od)}"
    assert sd == od
