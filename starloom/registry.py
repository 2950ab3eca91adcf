"""Query registry: each key maps to a Spark plan and its SQL twin.

``QUERIES[key](spark, sf_dir)`` returns the Spark DataFrame;
``ORACLE[key]`` is the same question as DuckDB/ANSI SQL over the supplied
tables (the warehouse roles appear as CTEs, see ``starloom.sources.sql``).
Column names and types agree on both sides: counts and years BIGINT, money
DOUBLE rounded to cents, ratios DOUBLE, dates DATE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.registry_sql import ORACLE
from starloom.sources.tables import Warehouse

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
# the plan behind each key, callable on any warehouse (e.g. ``RoleWarehouse``)
PLANS: dict[str, Callable[[Warehouse], DataFrame]] = {}


def register(key: str):
    def deco(fn: Callable[[Warehouse], DataFrame]):
        PLANS[key] = fn
        QUERIES[key] = lambda spark, sf_dir: fn(Warehouse(spark, sf_dir))
        QUERIES[key].__doc__ = fn.__doc__
        return fn
    return deco


def _load() -> None:
    # importing the modules fills QUERIES
    from starloom.plans import registered  # noqa: F401


_load()

__all__ = ["ORACLE", "PLANS", "QUERIES", "register"]
