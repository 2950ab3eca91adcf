"""Byte-level BPE encoding and decoding with overlapping chunks.

A text of up to ``CHUNK`` characters is one piece. A longer text is cut into
chunks that overlap; tasks pre-tokenise the chunks on their own, starting at
whatever character a chunk starts with. The pattern has no memory, so once two
neighbours agree on a boundary they agree on all that follow: the first common
boundary in the overlap is a seam. The stretches between seams are encoded in
parallel and joined. Neighbours without a common boundary in their overlap form
one stretch, so the result never depends on the chunk size.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, stored, text_of

CHUNK, OVERLAP = 32_768, 512
#: White space from this length on goes around the library's pattern, which keeps a
#: state for each of its characters. Behind such a run the pattern leaves its last
#: character to what follows; the rest of it is one match.
BLANKS = regex.compile(r"\s{10000,}")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(2)
def encoding(ranks: str) -> tiktoken.Encoding:
    """The vocabulary of a rank file; once per Python worker."""
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def ids_of(enc: tiktoken.Encoding, text: str) -> list[int]:
    """As encode_ordinary gives them, also where white space is very long."""
    out, at = [], 0
    for m in BLANKS.finditer(text):
        end = m.end() - (m.end() < len(text))
        out += enc.encode_ordinary(text[at:m.start()])
        out += enc._encode_single_piece(text[m.start():end])
        at = end
    return out + enc.encode_ordinary(text[at:])


def _cut(chunk: int, overlap: int):
    def run(batches):
        for b in batches:
            rows = [(r, k, at, t[at:at + chunk + overlap]) for r, t in zip(b.column(0).to_pylist(), text_of(b.column(1)))
                    for k, at in enumerate(range(0, len(t), chunk))]
            yield _table(rows, "r k at piece", [pa.int64()] * 3 + [pa.string()])
    return run


def _table(rows: list[tuple], names: str, types: list) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names.split())


def _bounds(chunk: int, overlap: int):
    """Boundaries that a chunk sees in its own first part and in the part that it
    shares with the next. A boundary behind white space is left out: there the
    pattern looks ahead."""
    pattern = regex.compile(public_tokenizers.PATTERN)

    def run(batches):
        for b in batches:
            rows = []
            for r, k, at, t in zip(*(b.column(i).to_pylist() for i in range(4))):
                seen = [m.start() for m in pattern.finditer(t)]
                good = [at + p for p in seen if p and not t[p - 1].isspace()]
                rows.append((r, k, [p for p in good if p < at + overlap], [p for p in good if p >= at + chunk]))
            yield _table(rows, "r k head tail", [pa.int64()] * 2 + [pa.list_(pa.int64())] * 2)
    return run


def _stretches(batches):
    for b in batches:
        rows = []
        for r, t, seams in zip(*(b.column(i).to_pylist() for i in range(3))):
            cuts = [0, *sorted(seams or []), len(t)]
            rows += [(r, k, t[i:j]) for k, (i, j) in enumerate(zip(cuts, cuts[1:]))]
        yield _table(rows, "r k text", [pa.int64()] * 2 + [pa.string()])


def _encode(ranks: str, keys: int):
    def run(batches):
        enc = encoding(ranks)
        for b in batches:
            ids = [np.asarray(ids_of(enc, t), np.int32) for t in text_of(b.column(keys))]
            off = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(keys)), pa.ListArray.from_arrays(off, flat)],
                                             names=[*b.schema.names[:keys], "ids"])
    return run


def encode(docs: DataFrame, ranks: str = RANKS, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> doc_id, ids
    (array<int>), a row per row, as tiktoken's encode_ordinary gives them.

    Null and empty texts have no ids; repeated rows and null ids are rows like
    any other; empty table: empty result. Only texts over a chunk are shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    short = docs.where(F.coalesce(F.length("text"), F.lit(0)) <= chunk)
    done = short.mapInArrow(_encode(ranks, 1), "doc_id long, ids array<int>")
    long = stored(docs.where(F.length("text") > chunk).withColumn("r", F.monotonically_increasing_id()), "long-texts")
    chunks = long.select("r", "text").mapInArrow(_cut(chunk, overlap), "r long, k long, at long, piece string").repartition("r", "k")
    seen = stored(chunks.mapInArrow(_bounds(chunk, overlap), "r long, k long, head array<long>, tail array<long>"), "bounds")
    pairs = seen.select("r", (F.col("k") + 1).alias("k"), "tail").join(seen.select("r", "k", "head"), ["r", "k"])
    seams = pairs.select("r", F.array_min(F.array_intersect("tail", "head")).alias("seam")) \
        .groupBy("r").agg(F.collect_list("seam").alias("seams"))  # as many as one text has chunks
    parts = long.join(seams, "r", "left").select("r", "text", "seams").mapInArrow(_stretches, "r long, k long, text string")
    ids = parts.repartition("r", "k").mapInArrow(_encode(ranks, 2), "r long, k long, ids array<int>")
    whole = ids.groupBy("r").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    return done.unionByName(long.select("r", "doc_id").join(whole, "r").select("doc_id", "ids"))


def _decode(ranks: str):
    def run(batches):
        enc = encoding(ranks)
        size = max(enc._mergeable_ranks.values()) + 1
        words = np.empty(size, object)
        for w, i in enc._mergeable_ranks.items():
            words[i] = w
        words = words.tolist()
        for b in batches:
            ids = b.column(1)
            off = ids.offsets.to_numpy() - ids.offsets[0].as_py()
            flat = ids.flatten().to_numpy().tolist()
            out = [b"".join(map(words.__getitem__, flat[i:j])) for i, j in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), ids, pa.array(out, pa.binary())], names=["doc_id", "ids", "bytes"])
    return run


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``encoded`` (doc_id, ids) -> doc_id, ids, bytes: the ids' raw bytes, joined."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(ranks), "doc_id long, ids array<int>, bytes binary")


def digests(decoded: DataFrame) -> DataFrame:
    """n_tokens and digests of ids and bytes, as the registered query returns them."""
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))
