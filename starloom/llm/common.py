"""Helpers shared by the text operators: table reads, scratch tables, word hashes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from starloom.session import ensure_checkpoint_dir

#: Rows of a batch handed to Python: with texts of a few KB, some MB.
BATCH_ROWS = 1000
#: Bytes of text that the vectorised word hashing looks at together.
SLICE_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a table; Spark reads it, so any store will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch of long texts holds in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) != BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, tag: str) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/starloom-llm-{tag}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write once under the shared checkpoint folder and read back: cuts the
    lineage, survives lost executors, and runs a shared sub-plan once."""
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_paths() -> list[str]:
    """The scratch folders of this process that are still there."""
    return list(_SCRATCH)


def release(spark: SparkSession, paths: list[str]) -> int:
    """Delete these scratch folders; call it when what depends on them is stored.
    Returns how many there were."""
    jvm, n = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        n += bool(p.getFileSystem(conf).delete(p, True))
        if path in _SCRATCH:
            _SCRATCH.remove(path)
    return n


# ---- word hashes over Arrow text, vectorised ------------------------------

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**64, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_R = np.uint64(0x9E3779B97F4A7C15)
_C = np.uint64(0xD6E8FEB86659FD93)
_POW = np.ones(64, np.uint64)
_POW[1:] = np.cumprod(np.full(63, _R, np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (first row, bytes, offsets) for runs of rows of about ``size`` bytes;
    a null is an empty text. A longer single text is a run of its own."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + size, "right")) - 1)
        j = min(j, n)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ([^\\x20\\x09-\\x0D]+) of each text, and where
    each text's words start (one entry more than texts)."""
    global _POW
    solid = ~_SPACE[data]
    at = np.flatnonzero(solid)
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    first = np.empty(len(at), bool)
    first[0] = True
    first[1:] = np.diff(at) > 1
    begins = np.searchsorted(at, off[:-1])
    first[begins[begins < len(at)]] = True
    starts = np.flatnonzero(first)
    lens = np.diff(np.append(starts, len(at)))
    if (longest := int(lens.max())) > len(_POW):
        size = 1 << longest.bit_length()
        _POW = np.ones(size, np.uint64)
        _POW[1:] = np.cumprod(np.full(size - 1, _R, np.uint64))
    inside = np.arange(len(at)) - np.repeat(starts, lens)
    h = np.add.reduceat((_BYTE_LOWER if lower else _BYTE)[data[at]] * _POW[inside], starts)
    return mix(h + lens.astype(np.uint64)), np.searchsorted(at[starts], off)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on (unmixed across texts:
    the caller leaves out those that cross a text's end)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, span, c = None, 0, words, 1, _C
    while True:  # binary doubling: power[i] covers span words from i
        if size & span:
            if out is None:
                out = power[:n].copy()
            else:
                out = out * c + power[done:done + n]
            done += span
        if span * 2 > size:
            break
        power = power[:-span] * c + power[span:]
        span *= 2
        c = np.uint64(int(c) * int(c) % 2**64)
    return mix(out + np.uint64(size))


def text_of(column: pa.Array) -> list[str]:
    return [s or "" for s in column.to_pylist()]
