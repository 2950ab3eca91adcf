"""WARC archives: write one record per page, read them back by boundary chains.

Writing deduplicates payloads by digest: of equal payloads of at least
``MIN_REVISIT`` bytes the one with the smallest page_id is a response record,
the others are revisit records without a block. Spark's text writer ends each
record with CRLF CRLF, so archives can be written to any store.

Reading never trusts the magic line alone. Spark's text reader cuts the files at
each magic (also within payloads); each task adds up byte positions, parses the
header behind each magic and emits the candidate with the offset where its
record would end, which is where the next record must start. Pointer jumping
over these links (doubling) marks what the chain from the file's start reaches;
a magic inside a payload is never reached. Payloads that a magic cuts in pieces
are put together again from the pieces.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import release, scratch_path, scratch_paths, small_batches, stored

# Fixed values of the WARC format.
MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"

MIN_REVISIT = 100
RECORDS_PER_FILE = 2048
#: Size of the bitmap of files whose payloads are read again, as a power of two (1 MiB).
FILE_BITS = 23
DATE = "2024-01-01T00:00:00Z"


def write_archives(pages: DataFrame, path: str, records_per_file: int = RECORDS_PER_FILE,
                   compression: str = "gzip") -> None:
    """``pages`` (page_id, url, html; other columns are ignored; nulls are
    empty) as WARC files under ``path``."""
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    own = stored(pages.select("page_id", F.octet_length("html").cast("long").alias("n"),
                              F.sha2(F.col("html").cast("binary"), 256).alias("digest")), "payloads")
    first = own.where(f"n >= {MIN_REVISIT}").groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")) \
        .where("first != last").select("digest", "first")
    # stored, so that its size is known before the payloads move: they stay where they are if it is small
    refs = stored(own.where(f"n >= {MIN_REVISIT}").join(first, "digest").where("page_id != first")
                  .select("page_id", "digest", "first").distinct(), "refs")
    rows = pages.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256)).join(refs, ["page_id", "digest"], "left")
    again = F.col("first").isNotNull()
    block = F.when(again, F.lit("")).otherwise(F.col("html"))
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    record = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn("page_id")), line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]+", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        F.when(again, F.concat(line("WARC-Refers-To", urn("first")), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", compression) \
        .option("maxRecordsPerFile", records_per_file).text(path)


_FIELD = re.compile(rb"^([A-Za-z0-9-]+):([^\n]*)$")
_LENGTH = re.compile(rb"^[0-9]{1,18}$")
_SEGMENT = ("file string, block long, rel long, size long, payload long, length long, kind string, record string, "
            "refers string, declared string, digest string, whole boolean")


def _header(value: bytes) -> tuple[int, dict] | None:
    """Where the block starts and the header fields, if ``value`` starts with a
    well-formed header that gives its length and type. A header has no magic inside,
    so it ends within ``value``, however long its url is."""
    end = value.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {}
    for x in value[:end].split(b"\r\n"):
        m = _FIELD.match(x)
        if not m:
            return None
        fields[m[1].lower()] = m[2].strip(b" \t")
    if not _LENGTH.match(fields.get(b"content-length", b"")) or b"warc-type" not in fields:
        return None
    return end + 4, fields


def _emit(batches):
    """Candidates of a task, a batch for each batch read."""
    names = [x.split()[0] for x in _SEGMENT.split(", ")]
    types = [pa.string(), *[pa.int64()] * 5, *[pa.string()] * 5, pa.bool_()]
    where, rel = None, 0
    for b in batches:
        rows = []
        for file, block, value in zip(*(b.column(i).to_pylist() for i in range(3))):
            if (file, block) != where:
                where, rel = (file, block), 0
            value = value or b""
            found = _header(value) if block or rel else None  # before the first magic of a file there is no record
            if found:
                at, f = found
                n = int(f[b"content-length"])
                text = lambda k: f[k].decode("utf-8", "replace") if k in f else None  # noqa: B023,E731
                whole = at + n <= len(value)
                sha = hashlib.sha256(memoryview(value)[at:at + n]).hexdigest() if whole else None
                rows.append((file, block, rel, len(value), at, n, text(b"warc-type"), text(b"warc-record-id"),
                             text(b"warc-refers-to"), text(b"warc-payload-digest"), sha, whole))
            else:
                rows.append((file, block, rel, len(value), *[None] * 8))
            rel += len(value) + len(MAGIC)
        cols = list(zip(*rows)) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)


def _pieces(wanted):
    """The pieces themselves with the same positions, of files whose bit is set (and
    of few others: the join on the positions drops these)."""
    def run(batches):
        bits, where, rel = wanted.value, None, 0
        for b in batches:
            at, keep = [], []
            for file, block, value, bit in zip(*(b.column(i).to_pylist() for i in range(4))):
                if (file, block) != where:
                    where, rel = (file, block), 0
                at.append(rel)
                keep.append(bits[bit >> 3] >> (bit & 7) & 1 == 1)
                rel += len(value or b"") + len(MAGIC)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(at, pa.int64()), b.column(2)],
                                             names=["file", "block", "rel", "value"]).filter(pa.array(keep, pa.bool_()))
    return run


def _bit(file: str):
    return F.pmod(F.xxhash64(file), F.lit(1 << FILE_BITS))


def _file_bits(files: DataFrame):
    """Broadcast bitmap of file names, 2 ** FILE_BITS bits at any number of files."""
    block, bits = 1 << 15, bytearray(1 << FILE_BITS - 3)
    parts = files.select(_bit("file").alias("p")).groupBy((F.col("p") / block).cast("long").alias("part")).agg(F.expr(f"bitmap_construct_agg(p % {block})"))
    for part, x in parts.collect():
        bits[part * block // 8:(part + 1) * block // 8] = x
    return files.sparkSession.sparkContext.broadcast(bytes(bits))


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").cast("long").alias("block"),
        F.col("value").cast("binary").alias("value"))


def reachable(candidates: DataFrame) -> DataFrame:
    """``candidates`` (file, start, next) -> (file, start) of those on the chain
    from start 0 of their file. Where every other candidate of a file is the next of one,
    all of them are: links lead forward, so going back ends at 0. The other files
    (a magic within a payload, a damaged place) take pointer jumping: each round
    follows links of twice the length."""
    t = candidates.select("file", "start", "next")
    loose = t.where("start != 0").join(t.select("file", F.col("next").alias("start")), ["file", "start"], "left_anti")
    doubtful = stored(loose.select("file").distinct(), "doubtful")
    if doubtful.isEmpty():
        return t.select("file", "start")
    return t.join(doubtful, "file", "left_anti").select("file", "start").unionByName(_jumped(t.join(doubtful, "file", "left_semi")))


def _jumped(candidates: DataFrame) -> DataFrame:
    t = stored(candidates.select("file", "start", F.col("next").alias("jump"), (F.col("start") == 0).alias("on")), "chain")
    seen, old = -1, []
    while True:
        on = t.where("on").count()
        release(candidates.sparkSession, old)
        if on == seen:
            return t.where("on").select("file", "start")
        seen, old = on, scratch_paths()[-1:]
        ahead = t.select("file", F.col("start").alias("jump"), F.col("jump").alias("far"))
        hit = t.where("on").select("file", F.col("jump").alias("start"), F.lit(True).alias("hit"))
        t = stored(t.join(hit, ["file", "start"], "left").join(ahead, ["file", "jump"], "left")
                   .select("file", "start", F.col("far").alias("jump"), (F.col("on") | F.coalesce("hit", F.lit(False))).alias("on")), "chain")


def unexplained(segments: DataFrame, records: DataFrame) -> DataFrame:
    """(file, bytes, reached) of files whose chain of records ends before the file does."""
    size = segments.groupBy("file").agg((F.sum(F.col("size") + len(MAGIC)) - len(MAGIC)).alias("bytes"))
    ends = records.groupBy("file").agg(F.max("next").alias("reached"))
    return size.join(ends, "file", "left").withColumn("reached", F.coalesce("reached", F.lit(0))).where("reached != bytes")


def read_archives(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Records of all WARC files under ``path``: file, start, kind, record (its
    id), refers (another's id),
    declared (the digest that its header names), payload_bytes, payload_digest (SHA-256 of the
    block as read). A chain ends at the first place where no record starts. Where that
    isn't the end of its file (a damaged or cut archive, a file that doesn't start with
    a record), ``strict`` raises and names the first such file and place; without it, the
    records up to there are returned."""
    small_batches(spark)
    seg = stored(_scan(spark, path).mapInArrow(_emit, _SEGMENT), "segments")
    total = seg.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    base = total.select("file", "block", F.coalesce(F.sum("bytes").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    begin = F.col("base") + F.col("rel") - len(MAGIC)
    seg = stored(seg.join(base, ["file", "block"]).withColumn("start", begin)
                 .withColumn("next", begin + len(MAGIC) + F.col("payload") + F.col("length") + len(END)), "placed")
    chain = reachable(seg.where("payload is not null").select("file", "start", "next"))
    rec = seg.where("payload is not null").join(chain, ["file", "start"])
    rec = stored(rec.select("file", "start", "next", "kind", "record", "refers", "declared", "payload", "length", "digest", "whole"), "records")
    if strict and (lost := unexplained(seg, rec).orderBy("file").first()):
        raise ValueError(f"{lost['file']}: no record starts at byte {lost['reached']} of {lost['bytes']}")
    broken = rec.where("not whole")
    if not broken.isEmpty():  # payloads with a magic inside: join their pieces
        last = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
        of = seg.select("file", "block", "rel", "start").join(
            rec.select("file", "start", F.col("start").alias("own"), "whole"), ["file", "start"], "left")
        of = of.select("file", "block", "rel", "start", F.last("own", True).over(last).alias("own"), F.last("whole", True).over(last).alias("w")) \
            .where("not w").drop("w")
        wanted = _file_bits(broken.select("file").distinct())
        pieces = _scan(spark, path).withColumn("bit", _bit("file")).mapInArrow(_pieces(wanted), "file string, block long, rel long, value binary")
        joined = pieces.join(of, ["file", "block", "rel"]).groupBy("file", "own").agg(
            F.sort_array(F.collect_list(F.struct("start", "value"))).alias("p"))
        magic = F.lit(MAGIC).cast("binary")
        bytes_ = F.aggregate("p", F.lit(None).cast("binary"), lambda a, x: F.when(a.isNull(), x["value"]).otherwise(F.concat(a, magic, x["value"])))
        mended = joined.select("file", F.col("own").alias("start"), bytes_.alias("bytes"))
        mended = mended.join(broken.select("file", "start", "payload", "length"), ["file", "start"]) \
            .select("file", "start", F.sha2(F.expr("substring(bytes, cast(payload + 1 as int), cast(length as int))"), 256).alias("joined"))
        rec = rec.join(mended, ["file", "start"], "left").withColumn("digest", F.coalesce("digest", "joined"))
    return rec.select("file", "start", "kind", "record", "refers", "declared", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"))


def page_records(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` as archives (to ``path``, by default a scratch folder) and
    return what reading them gives: page_id, payload_bytes, payload_digest,
    record_type, refers_to; a row per page, revisits with the bytes and digest
    of the payload that they refer to.

    Null or empty html is an empty payload and a response. A null page_id is
    written as ``null`` and never refers or is referred to. Rows that repeat a
    page_id are records of their own; equal payloads under one page_id are all
    responses. Empty table: empty result.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "warc")
    write_archives(pages, path)
    ident = lambda c: F.expr(f"try_cast(regexp_extract({c}, '<urn:page:([^>]*)>', 1) as bigint)")
    rec = stored(read_archives(spark, path).select(
        ident("record").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        ident("refers").alias("refers_to"), F.regexp_replace("declared", "^sha256:", "").alias("d")), "read")
    full = rec.where(f"record_type = 'response' and payload_bytes >= {MIN_REVISIT}") \
        .select(F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("n")).distinct()
    again = rec.where("record_type = 'revisit'").select("page_id", "record_type", "refers_to", "d").join(full, ["refers_to", "d"]) \
        .select("page_id", F.col("n").alias("payload_bytes"), F.col("d").alias("payload_digest"), "record_type", "refers_to")
    return rec.where("record_type = 'response'").drop("d").unionByName(again)
