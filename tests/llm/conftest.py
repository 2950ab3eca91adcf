import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def prepared(spark):
    entry._prepare(spark)


@pytest.fixture
def frame(spark):
    """Rows as (id, text) documents with further columns whose names clash with
    those that the operators use inside."""
    def make(rows, names=("doc_id", "text"), types=("long", "string")):
        schema = ", ".join(f"{n} {t}" for n, t in zip(names, types)) + ", key long, label string, r string, n string, h string"
        return spark.createDataFrame([(*r, 7, None, "x", "y", "z") for r in rows], schema)
    return make
