"""Secret scan: patterns, and a token-efficiency test for random strings.

Text in a language is cheap under a byte-pair vocabulary: its tokens hold
several characters. Random strings fall apart into short tokens. A run of
``SHORTEST`` or more key characters with under ``RATIO`` characters a token is
reported as ``random``, unless it is a known digest (hex of a usual length), a
UUID, a number or an identifier made of words that the vocabulary spells cheaply,
or overlaps a pattern's match.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.bpe import RANKS, encoding
from starloom.llm.common import small_batches, text_of

# The patterns of the base kinds, in the order of their names.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # maximal runs of HEX that are long enough
KINDS = ["assign", "access", "hex", "random"]
LEAST = {"assign": 6, "access": 20, "hex": 24}

SHORTEST, RATIO = 20, 2.0
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
_DIGEST = re.compile(r"[0-9a-f]+|[0-9A-F]+")
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}  # MD5, SHA-1, SHA-2
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_PART = re.compile(r"[+/_=-]+")
_WORDS = re.compile(r"([A-Za-z]+)[0-9]{0,4}|[0-9]+")


def _cheap(text: str, ratio: float, ranks: str) -> bool:
    return len(text) >= ratio * len(encoding(ranks).encode_ordinary(text))


def _known(run: str, ratio: float, ranks: str) -> bool:
    """A digest, UUID, number or identifier; letters alone don't make one, each part
    of it passes the token test too."""
    if _DIGEST.fullmatch(run) and len(run) in _DIGEST_LENGTHS or _UUID.fullmatch(run):
        return True
    parts = [p for p in _PART.split(run) if p]
    mixed = [p for p in parts if not p.isdigit() and not p.islower() and not p.isupper()]
    capitals = sum(c.isupper() for p in mixed for c in p)
    if capitals * 4 > sum(map(len, mixed)):
        return False
    words = [_WORDS.fullmatch(p) for p in parts]
    return all(words) and all(_cheap(w[1], ratio, ranks) for w in words if w[1])


def spans(text: str, ratio: float = RATIO, ranks: str = RANKS) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind as listed."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    found += [("hex", m.start(), m.end()) for m in LONG_HEX.finditer(text)]
    for m in _RUN.finditer(text):
        run, a, z = m[0], m.start(), m.end()
        if not _cheap(run, ratio, ranks) and not _known(run, ratio, ranks) \
                and not any(x < z and a < y for _, x, y in found):
            found.append(("random", a, z))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SPAN_SQL = "array<struct<kind: string, start: bigint, end: bigint>>"


def _scan(ratio: float, ranks: str):
    def run(batches):
        for b in batches:
            found = [[dict(zip(("kind", "start", "end"), s)) for s in spans(t, ratio, ranks)] for t in text_of(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(_SPAN))], names=["doc_id", "spans"])
    return run


def scan(docs: DataFrame, ratio: float = RATIO, ranks: str = RANKS) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> doc_id, spans (array
    of kind, start, end), a row per row. Null and empty texts have none; null ids
    and repeated rows are rows like any other; empty table: empty result."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan(ratio, ranks), f"doc_id long, spans {_SPAN_SQL}")


def digests(scanned: DataFrame) -> DataFrame:
    """Counts of the base kinds and the spans as text, as the registered query returns them."""
    base = F.filter("spans", lambda s: s["kind"] != KINDS[-1])
    said = lambda x: F.concat_ws(",", F.transform(x, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", *map(count, KINDS[:-1]), F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


def _mask(mark: str, ratio: float, ranks: str, at: int):
    def run(batches):
        for b in batches:
            out = []
            for text in b.column(at).to_pylist():
                if text is not None:
                    parts, last = [], 0
                    for _, a, z in spans(text, ratio, ranks):
                        if a >= last:
                            parts += [text[last:a], mark]
                        last = max(last, z)
                    text = "".join(parts) + text[last:] if parts else text
                out.append(text)
            cols = list(b.columns)
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names)
    return run


def redact(docs: DataFrame, mark: str = "[SECRET]", ratio: float = RATIO, ranks: str = RANKS) -> DataFrame:
    """``docs`` with each found span of ``text`` (spans that overlap count as one)
    replaced by ``mark``; all columns and rows stay. A null text stays null."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(_mask(mark, ratio, ranks, docs.columns.index("text")), docs.schema)
