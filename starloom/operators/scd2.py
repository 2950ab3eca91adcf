"""Type-2 slowly changing dimensions: apply a snapshot or a change log, look up a version.

A version row carries ``effective_start_date``, ``effective_end_date``
(inclusive; open versions end 9999-12-31) and ``current_flag`` 'Y'/'N'.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.keys import materialize, surrogate_key
from starloom.operators.scan import scan

OPEN_END = dt.date(9999, 12, 31)


def scd2_lookup(facts: DataFrame, dim: DataFrame, key: str, day_col: str,
                start_col: str = "effective_start_date", end_col: str = "effective_end_date") -> DataFrame:
    """Join each fact row to the dimension version valid on ``day_col``.

    An equi-join on the natural key with the validity range as an extra
    condition: the planner hashes (or broadcasts) on the key only, so the
    range adds no pairs beyond one key's versions.
    """
    d = dim.withColumnRenamed(key, "_scd_key")
    cond = ((F.col(key) == F.col("_scd_key"))
            & (F.col(day_col) >= F.col(start_col)) & (F.col(day_col) <= F.col(end_col)))
    return facts.join(d, cond).drop("_scd_key")


def scd2_merge_lookup(facts: DataFrame, dim: DataFrame, key: str, day_col: str, start_col: str = "effective_start_date",
                      end_col: str = "effective_end_date", ranges: int | None = None) -> DataFrame:
    """``scd2_lookup`` as an ordered merge: facts and versions are sorted together
    by (key, day), and the last version is carried forward to the facts behind it.

    A key with n versions and m facts costs n + m rows, not n * m pairs, and a hot
    key is spread over the ranges of the scan. The versions of a key must not
    overlap. Facts without a key or a day, and days without a version, find nothing.
    """
    attrs = [c for c in dim.columns if c != key]
    versions = dim.select(F.col(key).alias("_key"), F.col(start_col).alias("_day"), F.lit(0).alias("_kind"), F.struct(*attrs).alias("_version"))
    rows = facts.select(F.col(key).alias("_key"), F.col(day_col).alias("_day"), F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact"))
    both = versions.unionByName(rows, allowMissingColumns=True).where("_key IS NOT NULL AND _day IS NOT NULL")
    met = scan(both, ["_key"], ["_day", "_kind"], last={"_valid": "_version"}, ranges=ranges)
    return met.where((F.col("_kind") == 1) & (F.col("_day") <= F.col(f"_valid.{end_col}"))).select("_fact.*", *(f"_valid.{c}" for c in attrs))


def scd2_changes(dim: DataFrame, changes: DataFrame, keys: list[str], tracked: list[str], key_col: str = "sk",
                 day: str = "change_date", op: str = "op", seq: str = "change_seq", ranges: int | None = None) -> DataFrame:
    """Merge a log of dated changes into a type-2 dimension (``key_col``, ``keys``,
    ``tracked``, dates and flag).

    A change holds from its day until the next one that is known of its key, be it a later
    change of the log or the begin or end of a stored version. So several changes of a
    key make several versions, a late one splits the version of its day (closed or
    open), and one of a key that was absent then opens a version up to the next.
    ``op`` 'D' ends the key's validity from that day on. Neighbours with equal values (NULLs
    are equal) become one version. Of changes of a key on one day the highest ``seq``
    counts (then an update before a deletion, then the greater values).

    A version that begins on the day on which a stored one began keeps its key, new begins
    get dense keys above the maximum by (keys, day). Versions of keys without changes stay
    as they are. Changes without a key or a day are left out (a load gate lists them).
    """
    log = changes.where(" AND ".join(f"{c} IS NOT NULL" for c in [*keys, day]))
    hit = materialize(log.select(*keys).distinct(), "scd2-hit")
    dim = dim.select(key_col, *keys, *tracked, "effective_start_date", "effective_end_date", "current_flag")
    own = dim.join(hit, keys, "left_semi")
    value, none, first = F.struct(*tracked), F.lit(None), F.lit(0).cast("bigint")
    begins = own.select(*keys, F.col("effective_start_date").alias("_day"), F.lit(1).alias("_rank"), first.alias("_seq"), value.alias("_value"),
                        F.col(key_col).alias("_key"))
    ends = own.where(F.col("effective_end_date") < F.lit(OPEN_END)).select(
        *keys, F.date_add("effective_end_date", 1).alias("_day"), F.lit(0).alias("_rank"), first.alias("_seq"))
    new = log.select(*keys, F.col(day).alias("_day"), F.lit(2).alias("_rank"), F.col(seq).cast("bigint").alias("_seq"),
                     F.when(~F.col(op).eqNullSafe(F.lit("D")), value).otherwise(none).alias("_value"))
    events = begins.unionByName(ends, allowMissingColumns=True).unionByName(new, allowMissingColumns=True)
    # one event for a key and day: the log before a begin before an end
    events = events.groupBy(*keys, "_day").agg(F.max(F.struct("_rank", "_seq", "_value"))["_value"].alias("_value"), F.max("_key").alias("_key"))
    steps = scan(events, keys, ["_day"], previous={"_before": "_value"}, ranges=ranges).where(~F.col("_value").eqNullSafe(F.col("_before")))
    spans = scan(steps.drop("_before"), keys, ["_day"], following={"_next": "_day"}, ranges=ranges).where("_value IS NOT NULL")
    versions = materialize(spans.select(
        F.col("_key").alias(key_col), *keys, *(F.col(f"_value.{c}").alias(c) for c in tracked), F.col("_day").alias("effective_start_date"),
        F.coalesce(F.date_sub("_next", 1), F.lit(OPEN_END)).alias("effective_end_date"),
        F.when(F.col("_next").isNull(), "Y").otherwise("N").alias("current_flag")), "scd2-versions")
    start = dim.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("m")).scalar()
    opened = surrogate_key(versions.where(F.col(key_col).isNull()).drop(key_col), [*keys, "effective_start_date"], "_rel", 1)
    opened = opened.withColumn(key_col, (F.col("_rel") + start).cast("bigint"))
    kept = dim.join(hit, keys, "left_anti").unionByName(versions.where(F.col(key_col).isNotNull()))
    return kept.unionByName(opened.select(*dim.columns)).select(*dim.columns)


def scd2_apply(dim: DataFrame, snapshot: DataFrame, keys: list[str], tracked: list[str],
               as_of: dt.date, key_col: str = "sk") -> DataFrame:
    """Merge a full snapshot of the source into a type-2 dimension.

    * unchanged current versions stay as they are;
    * a changed current version is closed the day before ``as_of`` and a
      new current version opens on ``as_of``;
    * keys seen for the first time open a version on ``as_of``;
    * keys missing from the snapshot keep their current version.

    Changes are detected by comparing the tracked columns (NULL safe); new
    versions get surrogate keys above the current maximum. The merge is written
    once: both its kept and its opened rows are read from it.
    """
    cur = dim.filter(F.col("current_flag") == "Y")
    old = dim.filter(F.col("current_flag") != "Y")
    snap = snapshot.select(*keys, F.lit(True).alias("_in_new"), *[F.col(c).alias(f"_new_{c}") for c in tracked])
    j = materialize(cur.withColumn("_in_cur", F.lit(True)).join(snap, keys, "full_outer"), "scd2-merge")
    differs = reduce(or_, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in tracked])
    new_only = F.col("_in_cur").isNull()
    changed = F.col("_in_cur").isNotNull() & F.col("_in_new").isNotNull() & differs

    kept_or_closed = (j.filter(~new_only)
                      .withColumn("effective_end_date",
                                  F.when(changed, F.lit(as_of - dt.timedelta(days=1)))
                                  .otherwise(F.col("effective_end_date")))
                      .withColumn("current_flag", F.when(changed, "N").otherwise(F.col("current_flag")))
                      .select(*dim.columns))
    opened = (j.filter(changed | new_only)
              .select(*keys, *[F.col(f"_new_{c}").alias(c) for c in tracked])
              .withColumn("effective_start_date", F.lit(as_of))
              .withColumn("effective_end_date", F.lit(OPEN_END))
              .withColumn("current_flag", F.lit("Y")))
    # scalar subquery: the current maximum key, evaluated once
    start = dim.agg(F.coalesce(F.max(key_col), F.lit(0)).alias("m")).scalar()
    keyed = surrogate_key(opened, keys, "_sk_rel", 1)
    opened_k = keyed.withColumn(key_col, (F.col("_sk_rel") + start).cast("bigint")).drop("_sk_rel")
    return old.unionByName(kept_or_closed).unionByName(opened_k.select(*dim.columns))


def initial_versions(df: DataFrame, keys: list[str], start: dt.date, key_col: str = "sk",
                     key_start: int = 1) -> DataFrame:
    """First load of a type-2 dimension: one open, current version per key."""
    v = (df.withColumn("effective_start_date", F.lit(start))
         .withColumn("effective_end_date", F.lit(OPEN_END))
         .withColumn("current_flag", F.lit("Y")))
    return surrogate_key(v, keys, key_col, key_start)
