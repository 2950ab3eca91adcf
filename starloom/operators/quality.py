"""Integrity checks the storage engine enforced in the source (PK, FK, NOT
NULL, VARCHAR length) and the id-coverage profile, as DataFrames of
violations: an empty result means the constraint holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pk_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def fk_violations(child: DataFrame, parent: DataFrame, child_key: str,
                  parent_key: str | None = None) -> DataFrame:
    """Child rows whose non-NULL key has no parent (NULL keys pass, as in SQL)."""
    parent_key = parent_key or child_key
    p = parent.select(F.col(parent_key).alias("_fk_parent"))
    return (child.filter(F.col(child_key).isNotNull())
            .join(p, F.col(child_key) == F.col("_fk_parent"), "left_anti"))


def _long(df: DataFrame, counts: dict) -> DataFrame:
    """One pass computing every count, then unpivoted to (column_name, n)."""
    row = df.agg(*[c.alias(name) for name, c in counts.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in counts)
    return row.selectExpr(f"stack({len(counts)}, {pairs}) AS (column_name, n_violations)").select(
        "column_name", F.col("n_violations").cast("bigint"))


def null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULL count of each required column (one scan for all columns)."""
    return _long(df, {c: F.count_if(F.col(c).isNull()) for c in cols})


def length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Number of values longer than the declared VARCHAR length."""
    return _long(df, {c: F.count_if(F.length(c) > n) for c, n in limits.items()})


def key_coverage(df: DataFrame, key: str) -> DataFrame:
    """min / max / count / distinct count of a key (the id range the
    generators draw from)."""
    return df.agg(F.min(key).cast("bigint").alias("min_id"), F.max(key).cast("bigint").alias("max_id"),
                  F.count(key).cast("bigint").alias("n_rows"),
                  F.countDistinct(key).cast("bigint").alias("n_distinct"))
