"""Exact duplicates against a persistent digest index; DataFrame functions only.

The index is a table bucketed and sorted by digest. A batch of documents is
reduced to one row per digest and anti-joined with the index (sort-merge; the
index side is read in its buckets, without a shuffle). The digests that are new are
appended; of a known digest the batch appends what it adds: how many rows, and its
best one. A digest's rows in the index are merged when it is read, within their
bucket, so any number of batches gives what one batch would.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import scratch_path, stored

#: The characters that texts are compared without: [\x20\x09-\x0D].
BLANK = " \t\n\x0b\x0c\r"
#: Batches in which ``exact_duplicates`` passes a table through an index, and rows for each
#: bucket of a new index (it has the session's shuffle partitions at least).
BATCHES, BUCKET_ROWS = 2, 2_000_000


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_points (code points of the text as it is) and text_sha256 (of
    the text without blanks); null counts as empty."""
    text = F.coalesce("text", F.lit(""))
    bare = F.translate(text, BLANK, "")
    return docs.select("doc_id", F.length(text).cast("long").alias("n_points"),
                       F.sha2(bare.cast("binary"), 256).alias("text_sha256"))


class DigestIndex:
    """Bucketed table ``name`` of digests: text_sha256, keep_id, n_points, n_rows, one row
    for each batch that a digest was in. The number of buckets follows the first
    batch's rows unless given, and is stored with the table; ``path`` puts the
    files of the table into a folder of the caller's choice."""

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, path: str | None = None):
        self.spark, self.name, self.buckets, self.path = spark, name, buckets, path

    def read(self) -> DataFrame | None:
        """One row per digest: the best row of all batches (most code points, then the
        smallest doc_id) and the number of rows; read bucket by bucket."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        best = F.max(F.struct("n_points", (-F.col("keep_id")).alias("low"))).alias("best")
        return self.spark.table(self.name).groupBy("text_sha256").agg(best, F.sum("n_rows").alias("n_rows")) \
            .select("text_sha256", (-F.col("best.low")).alias("keep_id"), F.col("best.n_points").alias("n_points"), "n_rows")

    def _bucket_count(self, rows: int) -> int:
        if self.spark.catalog.tableExists(self.name):
            told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Num Buckets'").first()
            return int(told["data_type"])
        return self.buckets or max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))

    def append(self, groups: DataFrame, rows: int = 0) -> None:
        """Add rows of digests; they are dealt by the bucket function, so a task
        writes one sorted file of one bucket."""
        n = self._bucket_count(rows)
        writer = groups.select("text_sha256", "keep_id", "n_points", "n_rows").repartition(n, "text_sha256") \
            .write.format("parquet").mode("append").bucketBy(n, "text_sha256").sortBy("text_sha256")
        (writer.option("path", self.path) if self.path else writer).saveAsTable(self.name)

    def unknown(self, groups: DataFrame) -> DataFrame:
        """The groups whose digest the index lacks: the sort-merge anti-join."""
        return groups.join(self.spark.table(self.name).hint("merge"), "text_sha256", "left_anti")

    def add(self, rows: DataFrame) -> DataFrame:
        """Add ``rows`` (doc_id, n_points, text_sha256; stored). Returns one row per digest
        of theirs: text_sha256, keep_id (the index's, where it knew the digest), n_rows of
        this batch, and new."""
        # groups are small states (no rows), so a digest that a third of all rows has is summed before the shuffle
        groups = stored(rows.groupBy("text_sha256").agg(
            F.max(F.struct("n_points", (-F.col("doc_id")).alias("low"))).alias("best"), F.count(F.lit(1)).alias("n_rows"))
            .select("text_sha256", (-F.col("best.low")).alias("keep_id"), F.col("best.n_points").alias("n_points"), "n_rows"), "groups")
        known = self.read()
        if known is None:
            self.append(groups, groups.count())
            return groups.drop("n_points").withColumn("new", F.lit(True))
        fresh = stored(self.unknown(groups), "fresh")
        seen = stored(groups.join(known.select("text_sha256", F.col("keep_id").alias("known_id")).hint("merge"), "text_sha256"), "seen")
        self.append(fresh)
        self.append(seen)
        old = seen.select("text_sha256", F.col("known_id").alias("keep_id"), "n_rows", F.lit(False).alias("new"))
        return fresh.drop("n_points").withColumn("new", F.lit(True)).unionByName(old)

    def absorb(self, docs: DataFrame) -> DataFrame:
        """Judge every row of ``docs`` (doc_id, text; other columns are ignored)
        and add its digests.

        Returns doc_id, keep_id, group_size, kept, text_sha256, a row per row.
        Of equal texts the row with the most code points, then the smallest
        doc_id stays, unless the index knows the digest already: then the
        index's keep_id holds and no row of the batch is kept. group_size counts
        the rows of this batch. Null texts are empty texts; a null doc_id comes
        after all others; rows that repeat the doc_id that stays are one
        document and share its verdict. Empty table: empty result.
        """
        rows = stored(digests(docs), "digests")
        verdict = stored(self.add(rows), "verdict")
        keep = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id"))
        return rows.join(verdict, "text_sha256").select("doc_id", "keep_id", F.col("n_rows").alias("group_size"), keep.alias("kept"), "text_sha256")


def exact_duplicates(docs: DataFrame, batches: int = BATCHES, buckets: int | None = None) -> DataFrame:
    """Every row of ``docs`` judged over all of them: doc_id, keep_id, group_size, kept,
    text_sha256 (see DigestIndex.absorb for nulls and repeated rows).

    The rows pass through an index in ``batches`` parts (by a hash of doc_id and digest, so equal
    texts meet across parts): each but the first is anti-joined with what is there and
    appended. The merged index then holds the best row and the size of each group. It
    lives in a scratch folder; no table stays in the catalog.
    """
    spark = docs.sparkSession
    rows = stored(digests(docs), "digests")
    index = DigestIndex(spark, f"starloom_digests_{uuid.uuid4().hex}", buckets, scratch_path(spark, "index"))
    for k in range(batches):
        index.add(rows.where(F.pmod(F.xxhash64("doc_id", "text_sha256"), F.lit(batches)) == k))
    # stored without buckets: then both sides are shuffled and a hot digest's rows can be split
    whole = stored(index.read().drop("n_points"), "merged")
    spark.sql(f"DROP TABLE IF EXISTS {index.name}")
    return rows.join(whole, "text_sha256").select("doc_id", "keep_id", F.col("n_rows").alias("group_size"),
                                                  F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
