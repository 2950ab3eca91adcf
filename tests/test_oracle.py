"""Every registered query equals its SQL twin (DuckDB) on the smallest scale."""

import pytest

import __spark_entry__ as entry

from compare import assert_same
from conftest import SMALL

# the text operators have tests of their own, and not all can be said in SQL
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.TEXT_QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k not in entry.TEXT_QUERIES}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert_same(QUERIES[name](spark, SMALL), duck, ORACLE[name])


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "cal_year", "categoryname", "total_sales"]
    rows = df.collect()
    assert rows and all(1998 <= r.cal_year <= 2000 and r.total_sales > 0 for r in rows)
    assert {r.categoryname for r in rows} <= {"PROMO", "SMALL", "LARGE"}
