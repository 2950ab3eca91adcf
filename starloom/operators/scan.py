"""Scans over a global order: numbers, running totals, previous and next rows,
the last value carried forward.

A window over the whole order, or over one hot group of it, would put all its rows
into one task. Here the order is cut into ranges:

1. the rows are written once; a sample of the written rows bounds the ranges, so
   the child plan runs once;
2. each row finds its range by binary search over the bounds, and one shuffle sends
   each range to a task of its own, so a group of any size is spread over many tasks;
3. each range is scanned by itself (a window within the range);
4. what a range hands to its neighbours is one state for each group that a bound
   cuts: a count, a sum, a first or a last row. Only the rows of these groups are read
   again for it. A prefix scan over these few states combines them, and they are broadcast back to the
   rows that begin (or end) inside a range.

Nulls come first in the order and are equal to each other, in groups too.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.operators.store import materialize

RANGE, TIE = "_scan_range", "_scan_tie"
#: Fewest rows that are worth a range, most rows that one should have (its sort stays
#: in memory), and sampled rows for each range.
RANGE_ROWS, MOST_ROWS, SAMPLED = 20_000, 1_000_000, 100


def at_or_below(rows: DataFrame, points: Column, x: Column, most: int, name: str) -> DataFrame:
    """``rows`` with column ``name``: how many of the sorted array ``points`` (``most`` at the most)
    are not above ``x``. A binary search with a column for each step, so that all of it
    is compiled and ``x`` is built once for a row."""
    out, at = rows.select("*", points.alias("_scan_cuts"), x.alias("_scan_point")), F.lit(0)
    for s in (1 << i for i in reversed(range(max(1, most.bit_length())))):
        reached = F.coalesce(F.get("_scan_cuts", at + s - 1) <= F.col("_scan_point"), F.lit(False))
        out, at = out.withColumn(name, F.when(reached, at + s).otherwise(at)), F.col(name)
    return out.drop("_scan_cuts", "_scan_point")


def bounds(rows: DataFrame, order: list[str], ranges: int | None = None) -> tuple[DataFrame | None, int]:
    """Rows (stored as one column ``p``) of ``rows`` at which ranges of equal size begin, but
    for the first, and how many; None for one range. ``rows`` are stored and ``order`` is total.
    About twice the session's shuffle partitions, more where a range would exceed
    ``MOST_ROWS``, unless ``ranges`` says how many."""
    n = rows.count()
    if ranges is None:
        ranges = min(max(2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // MOST_ROWS), n // RANGE_ROWS)
    if ranges < 2 or n < 2:
        return None, 0
    few = rows.select(F.struct(*order).alias("p")).sample(min(1.0, ranges * SAMPLED / n), seed=1)
    nth = F.row_number().over(Window.orderBy("p"))  # a bounded sample
    cut = materialize(few.withColumn("i", nth).where(F.pmod("i", F.lit(max(2, min(n, ranges * SAMPLED) // ranges))) == 0).select("p"), "bounds")
    size = cut.count()
    return (cut, size) if size else (None, 0)


def placed(rows: DataFrame, order: list[str], cut: DataFrame | None, size: int) -> DataFrame:
    """``rows`` with their ``RANGE`` (0, 1, ...): how many bounds are not above them."""
    if cut is None:
        return rows.withColumn(RANGE, F.lit(0))
    return at_or_below(rows, cut.agg(F.sort_array(F.collect_list("p"))).scalar(), F.struct(*order), size, RANGE)


def with_ranges(rows: DataFrame, order: list[str], ranges: int | None = None) -> tuple[DataFrame, int]:
    """Add ``RANGE``: rows of a range come before those of the next one by ``order``; and how
    many there are (see ``bounds``)."""
    cut, size = bounds(rows, order, ranges)
    return placed(rows, order, cut, size), size + 1


def _carried(out: DataFrame, rows: DataFrame, by: list[str], full: list[str], cut: DataFrame, size: int, state: dict[str, Column]) -> DataFrame:
    """``out`` with what the ranges before (behind, for ``_f``) hand to each row's group."""
    if by:  # a group that goes on in the next range holds the row at which that begins
        ends = cut.select(*(F.col(f"p.{c}").alias(f"_end{i}") for i, c in enumerate(by))).distinct()
        rows = rows.join(F.broadcast(ends), reduce(and_, [F.col(c).eqNullSafe(F.col(f"_end{i}")) for i, c in enumerate(by)]), "left_semi")
    edge = placed(rows, full, cut, size)
    state = {"_n": F.count(F.lit(1))} | state
    states = edge.groupBy(RANGE, *by).agg(*(x.alias(c) for c, x in state.items()))
    # the prefix scan over them: a row or two for each range
    along = Window.partitionBy(*by).orderBy(RANGE)
    up, down = along.rowsBetween(Window.unboundedPreceding, -1), along.rowsBetween(1, Window.unboundedFollowing)
    over = {"_n": lambda c: F.sum(c).over(up), "_s": lambda c: F.sum(c).over(up), "_f": lambda c: F.first(c, True).over(down)}
    carry = [over.get(c[:2], lambda c: F.last(c, True).over(up))(c).alias(f"{c}_") for c in state]
    carried = states.select(F.col(RANGE).alias("_r"), *(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), *carry)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)], F.col(RANGE) == F.col("_r"))
    return out.join(F.broadcast(carried), same, "left")


def scan(df: DataFrame, by: list[str], order: list[str], number: str | None = None, sums: dict[str, str] | None = None,
         previous: dict[str, str] | None = None, following: dict[str, str] | None = None, last: dict[str, str] | None = None,
         ranges: int | None = None) -> DataFrame:
    """``df`` with columns that depend on the rows of the same ``by`` group before (or
    behind) a row in ``order``:

    * ``number``: its number within the group, from 1;
    * ``sums``: new column -> column whose running total it gets (its own value included);
    * ``previous``, ``following``: new column -> column of the row before, behind (NULL
      where there is none);
    * ``last``: new column -> column whose last non-NULL value up to this row it gets.

    Rows that tie in ``order`` come in a fixed, otherwise unspecified order. An empty
    frame gives an empty one.
    """
    sums, previous, following, last = sums or {}, previous or {}, following or {}, last or {}
    rows = materialize(df.withColumn(TIE, F.monotonically_increasing_id()), "scan")
    inner = [*dict.fromkeys([*order, TIE])]
    full = [*dict.fromkeys([*by, *inner])]
    cut, size = bounds(rows, full, ranges)
    parts = size + 1
    place = F.struct(*inner)

    own = Window.partitionBy(RANGE, *by).orderBy(*inner)
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    local = {"_n": F.row_number().over(own)} if number else {}
    local |= {f"_s{i}": F.sum(c).over(upto) for i, c in enumerate(sums.values())}
    local |= {f"_p{i}": F.lag(F.struct(c)).over(own) for i, c in enumerate(previous.values())}
    local |= {f"_f{i}": F.lead(F.struct(c)).over(own) for i, c in enumerate(following.values())}
    local |= {f"_l{i}": F.last(c, True).over(upto) for i, c in enumerate(last.values())}
    out = placed(rows, full, cut, size).repartitionById(parts, F.col(RANGE)).select("*", *(x.alias(c) for c, x in local.items()))
    if parts > 1:  # else there is nothing to carry
        out = _carried(out, rows, by, full, cut, size, {
            **{f"_s{i}": F.sum(c) for i, c in enumerate(sums.values())},
            **{f"_p{i}": F.max_by(F.struct(c), place) for i, c in enumerate(previous.values())},
            **{f"_f{i}": F.min_by(F.struct(c), place) for i, c in enumerate(following.values())},
            **{f"_l{i}": F.max_by(F.col(c), F.when(F.col(c).isNotNull(), place)) for i, c in enumerate(last.values())}})
    near = lambda c: F.coalesce(c, f"{c}_") if parts > 1 else F.col(c)
    total = lambda c: F.coalesce(F.col(c) + F.col(f"{c}_"), c, f"{c}_") if parts > 1 else F.col(c)
    made = {number: total("_n").cast("bigint")} if number else {}
    made |= {c: total(f"_s{i}") for i, c in enumerate(sums)}
    made |= {c: near(f"_p{i}")[previous[c]] for i, c in enumerate(previous)}
    made |= {c: near(f"_f{i}")[following[c]] for i, c in enumerate(following)}
    made |= {c: near(f"_l{i}") for i, c in enumerate(last)}
    return out.select(*df.columns, *(x.alias(c) for c, x in made.items()))
