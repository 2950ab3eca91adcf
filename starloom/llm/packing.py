"""Packing token sequences into windows by Karmarkar-Karp differencing.

Texts are tokenised and cut: whole windows of a long document stand alone, and
what is left of it is cut into pieces of at most ``PIECE`` tokens. Runs of
documents (``WINDOWS`` windows' worth, so bounded) are packed together: k-way
differencing merges the two partial partitions with the largest spread, largest
sums against smallest, until one partition with near-equal windows is left. k
starts at the least number of windows and rises while any window is over its
capacity. No shuffle: each task packs what it reads, and a sequence's id names
the task's partition and a counter, so a task that runs again gives the same.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starloom.llm.common import small_batches, text_of

CAPACITY, PIECE, WINDOWS = 2048, 512, 128
TOKENIZER, END_ID = public_tokenizers.path("word_bpe_49k.json"), 1
#: Words that a worker remembers; then it starts anew.
MEMORY = 1_600_000


#: Words of small Latin letters only: one word of the model each.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


class WordTokens:
    """Ids of texts, word by word: this tokenizer drops white space and never
    joins across it, so the ids of a text are those of its words in turn. A comma
    or full stop behind an ASCII letter or digit is a token of its own, and case
    makes no difference, so such words are learnt by their stems. A word that holds an
    added token (such as ``<|endoftext|>``, in whatever case) is learnt as it is."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.known: dict[bytes, bytes] = {}
        self.model = Tokenizer.from_file(path)
        # what the tokenizer takes out of a text before anything else, as it stands
        self.added = [t.content.lower().encode() for t in self.model.get_added_tokens_decoder().values()]
        self.sign = os.path.commonprefix(self.added)
        vocab = self.model.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True

    def learn(self, words: set[bytes]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > MEMORY:
            self.known.clear()
            new = words
        marks, stems = {b",", b"."}, {}
        for w in new:
            if w.isascii():
                stem = w.lower()
            else:  # letters whose small form is one letter, whatever stands beside them
                t = w.decode("utf-8", "replace")
                stem = t.lower().encode() if max(t) < "\u0250" and "\u0130" not in t else w
            if self.sign in w.lower() and any(a in w.lower() for a in self.added):
                stems[w] = (w, b"")
            elif stem[-1:] in marks and stem[-2:-1].isalnum():  # of bytes: an ASCII letter or digit
                stems[w] = (stem[:-1], stem[-1:])
            else:
                stems[w] = (stem, b"")
        self._encode(({x for x, _ in stems.values()} | marks).difference(self.known))
        for w, (stem, mark) in stems.items():
            if w not in self.known:
                self.known[w] = self.known[stem] + (self.known[mark] if mark else b"")

    def _encode(self, stems: set[bytes]) -> None:
        plain = [w for w in stems if _LETTERS.fullmatch(w)]
        for i in range(0, len(plain), 500):  # many words at once; each ends with the one token that ends a word
            part = plain[i:i + 500]
            e = self.model.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0]
            ids = np.array(e.ids, "<u4")
            raw, ends = ids.tobytes(), (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            self.known.update(zip(part, (raw[x:y] for x, y in zip([0, *ends], ends))))
        odd = list(stems.difference(plain))
        for w, e in zip(odd, self.model.encode_batch_fast([w.decode("utf-8", "replace") for w in odd], add_special_tokens=False)):
            self.known[w] = np.array(e.ids, "<u4").tobytes()

    def ids(self, texts: list[str], at_once: int = 500_000):
        """Each text's ids, as little-endian unsigned 32-bit numbers; new words of
        texts of together about ``at_once`` characters are learnt together."""
        words, size = [], 0
        for n, text in enumerate(texts, 1):
            words.append(text.encode("utf-8", "replace").split())
            size += len(text)
            if size >= at_once or n == len(texts):
                self.learn(set().union(*words))
                for x in words:
                    yield b"".join(map(self.known.__getitem__, x))
                words, size = [], 0


@lru_cache(2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


def differencing(lengths: np.ndarray, k: int) -> np.ndarray:
    """The window (0..k-1) of each item by k-way Karmarkar-Karp differencing."""
    n = len(lengths)
    if k == 1 or n == 0:
        return np.zeros(n, np.int64)
    sums, heap = [], []
    for i, x in enumerate(lengths.tolist()):
        s = np.zeros(k, np.int64)
        s[0] = x
        sums.append(s)
        heap.append((-x, i))
    heapq.heapify(heap)
    merged = []
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        s = sums[a] + sums[b][::-1]  # opposing imbalances
        order = np.argsort(-s, kind="stable")
        s = s[order]
        s -= s[-1]
        merged.append((a, b, order))
        sums[a] = sums[b] = None
        heapq.heappush(heap, (-int(s[0]), len(sums)))
        sums.append(s)
    at = [None] * len(sums)
    at[-1] = np.arange(k)
    for m in range(len(merged) - 1, -1, -1):
        a, b, order = merged[m]
        w = np.empty(k, np.int64)
        w[order] = at[n + m]
        at[a], at[b], at[n + m] = w, w[::-1], None
    return np.array([at[i][0] for i in range(n)])


def windows(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Windows of at most ``capacity``, as few as differencing reaches."""
    k = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        w = differencing(lengths, k)
        if np.bincount(w, lengths, k).max(initial=0) <= capacity:
            return w, k
        k += 1


def _pack(path: str, end_id: int, capacity: int, piece: int, n_windows: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        tokens, part = word_tokens(path), TaskContext.get().partitionId()
        held, size, following = [], 0, part << 40

        def flush():
            nonlocal following
            rows, items = [], []
            for doc, raw in held:
                n = len(raw) // 4
                whole = n - n % capacity
                for i in range(0, whole, capacity):
                    rows.append((doc, i, capacity, zlib.crc32(raw[4 * i:4 * (i + capacity)]), n, following, 0))
                    following += 1
                items += [(doc, raw, n, i, min(piece, n - i)) for i in range(whole, n, piece)]
            w, k = windows(np.array([x[4] for x in items], np.int64), capacity)
            fill = [0] * k
            for (doc, raw, n, i, m), j in zip(items, w.tolist()):
                rows.append((doc, i, m, zlib.crc32(raw[4 * i:4 * (i + m)]), n, following + j, fill[j]))
                fill[j] += m
            following += k
            held.clear()
            types = [pa.int64()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_NAMES)

        for b in batches:
            for doc, raw in zip(b.column(0).to_pylist(), tokens.ids(text_of(b.column(1)))):
                raw += end
                held.append((doc, raw))
                size += len(raw) // 4 % capacity
                if size >= n_windows * capacity or len(held) >= 64 * n_windows:
                    yield flush()
                    size = 0
        if held:
            yield flush()
    return run


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, capacity: int = CAPACITY, piece: int = PIECE,
         n_windows: int = WINDOWS) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> a row per piece:
    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone. Null ids and repeated rows are
    documents of their own. Empty table: empty result.
    """
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _pack(tokenizer, end_id, capacity, piece, n_windows), ", ".join(f"`{x}` long" for x in _NAMES))
