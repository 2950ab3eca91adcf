"""A gate before a load: each row with the set of rules that it breaks.

One pass marks the rows; those that break nothing are appended, the others go to
a reject table together with their reasons, so accepted + rejected = given.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.store import materialize
from starloom.sources.io import append_by_name, write_table

ROW, BROKEN = "_gate_row", "broken_rules"


def _present(cols: list[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols])


def marked(rows: DataFrame, checks: dict[str, Column] | None = None, required: list[str] | None = None, lengths: dict[str, int] | None = None,
           key: list[str] | None = None, target: DataFrame | None = None, first_by: list[str] | None = None,
           parents: dict[str, tuple[DataFrame, list[str], list[str]]] | None = None) -> DataFrame:
    """``rows`` with ``broken_rules``, the sorted names of the rules that each breaks:

    * ``checks``: name -> condition; NULL passes, as in SQL;
    * ``required``: columns that must not be NULL (``null:column``);
    * ``lengths``: column -> most characters (``length:column``);
    * ``key``: must not be NULL (``key:null``), must not be in ``target`` yet (``key:exists``), and
      of rows that share it only the first by ``first_by`` passes (``key:repeated``);
    * ``parents``: name -> (table, child columns, parent columns); a key without a NULL must
      be there (``parent:name``).

    The marks of keys are joined in from one row per key, found by partial aggregates, so a
    hot key costs no more than others. What the rows are joined with is stored before: only keys
    that repeat meet ``first_by``, only keys without a parent are joined in, and both
    are broadcast where they are few. Empty input: empty result.
    """
    stored = materialize(rows.withColumn(ROW, F.monotonically_increasing_id()), "gate")
    # the rules of a row alone are judged first: what they look at need not move for the keys
    broken = {name: ~F.coalesce(ok, F.lit(True)) for name, ok in (checks or {}).items()}
    broken |= {f"null:{c}": F.col(c).isNull() for c in required or []}
    broken |= {f"length:{c}": F.length(c) > n for c, n in (lengths or {}).items()}
    out, helpers = stored.select("*", *(c.alias(f"_rule{i}") for i, c in enumerate(broken.values()))), []
    bad = [F.when(F.col(f"_rule{i}"), F.lit(name)) for i, name in enumerate(broken)]
    if key:
        order = F.struct(*(first_by or []), ROW)
        known = stored.where(_present(key))
        twice = materialize(known.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), "gate-repeated")
        firsts = materialize(known.join(twice, key, "left_semi").groupBy(*key).agg(F.min(order)[ROW].alias("_first")), "gate-firsts")
        out = out.join(firsts, key, "left")
        bad += [F.when(~_present(key), F.lit("key:null")), F.when(F.col("_first") != F.col(ROW), F.lit("key:repeated"))]
        helpers.append("_first")
        if target is not None:
            out = out.join(target.select(*key).distinct().withColumn("_old", F.lit(True)), key, "left")
            bad.append(F.when(F.col("_old"), F.lit("key:exists")))
            helpers.append("_old")
    for i, (name, (table, child, parent)) in enumerate((parents or {}).items()):
        there = table.select(*(F.col(p).alias(f"_p{i}_{j}") for j, p in enumerate(parent)))
        same = reduce(and_, [F.col(c) == F.col(f"_p{i}_{j}") for j, c in enumerate(child)])
        orphans = stored.where(_present(child)).select(*child).distinct().join(there, same, "left_anti")
        orphans = materialize(orphans.select(*(F.col(c).alias(f"_p{i}_{j}") for j, c in enumerate(child)), F.lit(True).alias(f"_gone{i}")), "gate-orphans")
        out = out.join(orphans, same, "left")
        bad.append(F.when(F.col(f"_gone{i}"), F.lit(f"parent:{name}")))
        helpers += [f"_gone{i}", *(f"_p{i}_{j}" for j in range(len(parent)))]
    return out.withColumn(BROKEN, F.array_sort(F.array_compact(F.array(*bad)))).select(*rows.columns, BROKEN)


def load(rows: DataFrame, path: str, rejects: str, partition_by: list[str] | None = None, **rules) -> tuple[int, int]:
    """Append the rows that pass (see ``marked``) to the table at ``path`` and the others
    with their reasons to that at ``rejects``, both made if absent. Returns how many
    were accepted and rejected. The table itself is the ``target`` of the key unless another is given."""
    spark = rows.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    there = folder(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists
    if rules.get("key") and "target" not in rules and there(folder(path)):
        rules["target"] = spark.read.parquet(path)
    seen = materialize(marked(rows, **rules), "gated")
    good, bad = seen.where(F.size(BROKEN) == 0).drop(BROKEN), seen.where(F.size(BROKEN) > 0)
    n_good, n_bad = good.count(), bad.count()
    # rejects first: a load that stops between the two can be told from them and begun anew
    for part, where, by, n in ((bad, rejects, None, n_bad), (good, path, partition_by, n_good)):
        if not there(folder(where)):
            write_table(part, where, by)
        elif n:
            append_by_name(part, where, spark, by)
    return n_good, n_bad
