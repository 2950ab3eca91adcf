"""Corpus pipeline: stages over documents, each of them one of the text operators.

A stage takes the documents that its predecessor kept and returns the columns of
documents (the last one returns the pieces of packed sequences). Each result is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import packing, secrets, toxicity
from starloom.llm.common import release, scratch_path, scratch_paths, stored
from starloom.llm.exact import exact_duplicates
from starloom.llm.minhash import near_duplicates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []
#: Similarity of near copies in the near stage; the 85 of op1 is that query's contract.
NEAR_PERCENT = 80
_ROW, _SIZE = "__row", "__size"


def stage(fn: Stage) -> Stage:
    """Delete what the stage before has stored on its way, unless its result is
    still computed from that (it wasn't written), and note what this one stores."""
    @wraps(fn)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        read = docs.inputFiles()
        release(spark, [p for p in _left if not any(p.rsplit("/", 1)[-1] in f for f in read)])
        before = set(scratch_paths())
        out = fn(spark, docs, sf_dir)
        _left[:] = [p for p in scratch_paths() if p not in before]
        return out
    return run


def _one_of_each(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], group: str, *order: Column) -> DataFrame:
    """One row of each ``group`` that ``judge`` finds, whatever the rows' doc_id: the
    operator gets a key of the row in its place (null and repeated ids are judged like
    any other row). The first by ``order``, then the smallest doc_id stays; null comes last."""
    rows = stored(docs.withColumn(_ROW, F.monotonically_increasing_id()).withColumn(_SIZE, F.length(F.coalesce("text", F.lit("")))), "rows")
    verdict = judge(rows.select(F.col(_ROW).alias("doc_id"), "text")).select(F.col("doc_id").alias(_ROW), F.col(group).alias("group"))
    first = F.struct(*order, F.col("doc_id").isNull().alias("none"), "doc_id", _ROW)
    kept = verdict.join(rows.select(_ROW, _SIZE, "doc_id").hint("merge"), _ROW).groupBy("group").agg(F.min_by(_ROW, first).alias(_ROW))
    return rows.join(kept.select(_ROW).hint("merge"), _ROW, "left_semi").select(docs.columns)


@stage
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go; learnt from the labels of documents
    that are there."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.harmless(docs, toxicity.fit(docs, labels))


@stage
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the most code points."""
    return _one_of_each(docs, exact_duplicates, "text_sha256", -F.col(_SIZE))


@stage
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.80)."""
    return _one_of_each(docs, lambda rows: near_duplicates(rows, NEAR_PERCENT), "component_id")


@stage
def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; each secret in a text is replaced by a mark."""
    out = secrets.redact(docs)
    if "n_chars" in out.columns:  # the length of the text as it is now
        out = out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast(out.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out


@stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage), ("exact_dedup", exact_stage), ("minhash_near_dedup", near_stage), ("secret_scan", secret_stage),
    ("packing", packing_stage)]
ORACLE_SQL = None  # a trained classifier, a tokenizer and a packing can't be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to documents; returns the last stage's result as it was written."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, fn in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        fn(spark, docs, sf_dir).write.parquet(path)
        if last:
            release(spark, [last])
        docs, last = spark.read.parquet(path), path
    release(spark, [p for p in _left if p != last])
    _left.clear()
    return docs
