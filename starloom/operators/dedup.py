"""Repeated (order, product) lines: find them, list them, remove them.

The source marks every line after the first of a repeated pair, walking a
sorted cursor. Here "first" is the lowest record number, i.e. the smallest
line in the natural order of all columns, and every step is a set-based
aggregate whose partial (map-side) phase collapses a hot pair before the
shuffle, so one pair holding a large share of the rows stays cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.store import materialize

PAIR = ["orderid", "productid"]


def orders_with_duplicates(lines: DataFrame) -> DataFrame:
    """Orders where ``COUNT(productid) > COUNT(DISTINCT productid)``."""
    per_pair = lines.filter(F.col("productid").isNotNull()).groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n"))
    return (per_pair.groupBy("orderid").agg(F.max("n").alias("max_n"))
            .filter(F.col("max_n") > 1).select("orderid"))


def duplicate_candidates(lines_with_rec: DataFrame) -> DataFrame:
    """All lines of the orders above, labelled ``orderid-productid``."""
    dup_orders = orders_with_duplicates(lines_with_rec)
    return (lines_with_rec.join(dup_orders, "orderid", "left_semi")
            .select("rec_no",
                    F.concat_ws("-", F.col("orderid").cast("string"),
                                F.col("productid").cast("string")).alias("order_product")))


def duplicate_rec_nos(lines_with_rec: DataFrame) -> DataFrame:
    """Record numbers of every line after the first of its (order, product).
    The repeated pairs are stored, so their size is known before the lines move."""
    firsts = materialize(lines_with_rec.groupBy(*PAIR)
                         .agg(F.min("rec_no").alias("first_rec"), F.count(F.lit(1)).alias("n"))
                         .filter(F.col("n") > 1), "repeated-pairs")
    return (lines_with_rec.join(firsts, PAIR)
            .filter(F.col("rec_no") > F.col("first_rec"))
            .select("rec_no"))


def first_per_pair(lines: DataFrame, order_cols: list[str], keep: list[str]) -> DataFrame:
    """Keep the first line (by ``order_cols``) of each (order, product).

    ``min(struct(order_cols..., keep...))`` is an ordinary aggregate with a
    partial phase, so it needs neither a window over the pair (one task per
    hot pair) nor the record numbers themselves.
    """
    rest = [c for c in order_cols if c not in PAIR]
    payload = [c for c in keep if c not in PAIR and c not in rest]
    first = F.min(F.struct(*[F.col(c) for c in rest + payload])).alias("_first")
    g = lines.groupBy(*PAIR).agg(first)
    return g.select(*PAIR, *[F.col(f"_first.{c}").alias(c) for c in rest + payload]).select(*keep)


def duplicate_summary(lines: DataFrame) -> DataFrame:
    """Rows, distinct (order, product) pairs, and rows a dedup removes."""
    per_pair = lines.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("n"))
    return per_pair.agg(F.sum("n").cast("bigint").alias("total_rows"),
                        F.count(F.lit(1)).cast("bigint").alias("distinct_pairs"),
                        (F.sum("n") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"))


def delete_by_rec_no(lines_with_rec: DataFrame, marked: DataFrame) -> DataFrame:
    """``DELETE FROM t WHERE rec_no IN (SELECT rec_no FROM marked)`` as a
    left anti join (NOT IN would turn a NULL into "delete nothing")."""
    return lines_with_rec.join(marked.select("rec_no"), "rec_no", "left_anti")
