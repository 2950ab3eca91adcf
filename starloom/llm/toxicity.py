"""Toxicity by a support vector machine on a subsequence string kernel.

Kernel strings are the words of a text's sentences, in small letters and with
marks for begin and end, and runs of single letters read as one word
("i d i o t"). The kernel counts common subsequences of ``LENGTH`` characters,
each weighted by ``DECAY`` to the power of the stretch it takes in both strings
(gaps up to ``STRETCH`` characters), over a norm of the strings' lengths. So a
word with inserted or left out characters stays close to the plain word.

Nyström landmarks stand for the kernel's feature space: K(x, Z) K(Z, Z)^(-1/2)
is a vector on which a linear machine with squared hinge loss is trained. As the
kernel is a product of subsequence weights, the trained machine folds into one
weight for each subsequence, with which any string is scored without looking at
the landmarks again.

A text's score comes from its ``WORST`` worst distinct strings, through a logistic
curve that is fitted to labelled texts.

Labels say which texts are toxic, not where. Strings for training are chosen on
a bounded sample of labelled texts (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``, by a
hash of the id): parts of words whose texts are toxic far more often than chance
allows (near copies of a text count once) mark toxic strings, which are also learnt with a character inserted,
doubled or exchanged; words of clean texts are the other class, at first at
random, then in rounds those that the machine errs on. Everything else (scoring)
covers all rows and whole texts.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import small_batches, stored, text_of
from starloom.llm.minhash import shingle_sets

LENGTH, STRETCH, DECAY, BITS = 4, 8, 0.7, 20
SAMPLE_TOXIC, SAMPLE_CLEAN = 2000, 8000
STRINGS, LANDMARKS, PARTS, ROUNDS, HARD = 4000, 400, 2000, 3, 1500
THRESHOLD, HELD_OUT = 0.7, 1
#: Strings of a text that count, and the score in place of one that is missing.
WORST, NONE = 3, -2.0
#: Words whose score a worker remembers (some 200 bytes each), and words scored together.
MEMORY, TOGETHER = 500_000, 5_000

_EDGE = re.compile(r"^\W+|\W+$")
_LETTERS = re.compile(r"(?<!\S)\w(?:[^\S\n]+\w(?!\S)){2,}")
_CODE = np.arange(0x110000, dtype=np.int64) % 31 + 32
_CODE[ord("a"):ord("z") + 1] = np.arange(1, 27)
_CODE[ord("0"):ord("9") + 1] = 27
_CODE[ord("^")], _CODE[ord("$")] = 28, 29
#: The places of the later characters of a subsequence behind its first.
_STEPS = list(combinations(range(1, STRETCH), LENGTH - 1))


def words_of(text: str) -> set[str]:
    """The kernel strings of a text, as they stand there."""
    out = set(text.split())
    out.update("".join(m[0].split()) for m in _LETTERS.finditer(text))
    return out


def plain(word: str) -> str:
    return _EDGE.sub("", word.lower())


def _subsequences(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(string number, subsequence number, weight) of one step after the other."""
    texts = [f"^{w}$" for w in words]
    n = np.array([len(t) for t in texts], np.int64)
    flat = _CODE[np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4")]
    own = np.repeat(np.arange(len(texts)), n)
    left = np.repeat(np.cumsum(n), n) - np.arange(len(flat)) - 1  # characters behind this one
    norm = np.zeros(len(texts))
    for step in _STEPS:
        norm += np.maximum(n - step[-1], 0) * DECAY ** (2 * (step[-1] + 1))
    norm = np.sqrt(np.maximum(norm, 1e-12))

    def made(step):
        at = np.flatnonzero(left >= step[-1])
        code = flat[at]
        for i in step:
            code = code * 64 + flat[at + i]
        who = own[at]
        return who, (code * 0x9E3779B1 & 0xFFFFFFFF) >> 32 - BITS, np.full(len(at), DECAY ** (step[-1] + 1)) / norm[who]
    return map(made, _STEPS)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string number, subsequence number, weight) of all subsequences; weights
    hold the norm of the string's length."""
    return tuple(map(np.concatenate, zip(*_subsequences(words))))


@dataclass
class Model:
    """Subsequence weights, bias, and the logistic curve over a text's worst strings."""

    weights: np.ndarray
    bias: float
    slopes: tuple = (1.0,) + (0.0,) * (WORST - 1)
    shift: float = 0.0

    def strings(self, words: list[str]) -> np.ndarray:
        """Their scores, step by step: all subsequences at once take 800 bytes a character."""
        out = np.zeros(len(words))
        for i in range(0, len(words), TOGETHER):
            part = out[i:i + TOGETHER]
            for who, what, weight in _subsequences(words[i:i + TOGETHER]):
                np.add.at(part, who, self.weights[what] * weight)
        return out + self.bias


#: What every text gets where there is nothing to learn from.
def _no_model() -> Model:
    return Model(np.zeros(2 ** BITS, np.float32), -1.0, shift=-3.0)


def _kernel(words: list[str], columns: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Kernel values of words and landmarks; z: subsequences x landmarks."""
    out = np.zeros((len(words), z.shape[1]))
    for i in range(0, len(words), 100):
        who, what, weight = features(words[i:i + 100])
        at = columns[what]
        ok = np.flatnonzero(at >= 0)
        ok = ok[np.argsort(who[ok], kind="stable")]
        if len(ok):
            own, start = np.unique(who[ok], return_index=True)
            out[i + own] = np.add.reduceat(z[at[ok]] * weight[ok, None].astype(np.float32), start)
    return out


def _svm(x: np.ndarray, y: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Linear machine, squared hinge, classes weighted alike; Newton's method."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    c = np.where(y > 0, cost / max(1, (y > 0).sum()), cost / max(1, (y < 0).sum()))
    w, ridge = np.zeros(x1.shape[1]), np.ones(x1.shape[1])
    ridge[-1] = 1e-3
    for _ in range(30):
        inside = y * (x1 @ w) < 1
        a = x1[inside] * c[inside, None]
        new = np.linalg.solve(np.diag(ridge) + a.T @ x1[inside], a.T @ y[inside])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:-1], float(w[-1])


def _variants(words: list[str]) -> list[str]:
    """Each word with a character inserted, one doubled and one exchanged, at
    places that depend on the word alone."""
    out = []
    for w in words:
        if len(w) >= 4:
            h = zlib.crc32(w.encode())
            i = 1 + h % (len(w) - 1)
            out += [w[:i] + ".-*_"[h >> 8 & 3] + w[i:], w[:i] + w[i - 1:], w[:i] + "0.*x"[h >> 10 & 3] + w[i + 1:]]
    return out


class Machine:
    """Landmarks, Nyström features and the linear machine on them."""

    def __init__(self, toxic: list[str], clean: list[str], cost: float = 3000.0):
        self.cost, self.toxic = cost, toxic + _variants(toxic)
        every = -(-len(toxic) // (LANDMARKS * 3 // 4))
        marks = toxic[::every]
        marks = marks + clean[:LANDMARKS - len(marks)]
        who, what, weight = features(marks)
        self.used = np.unique(what)
        self.columns = np.full(2 ** BITS, -1, np.int64)
        self.columns[self.used] = np.arange(len(self.used))
        self.z = np.zeros((len(self.used), len(marks)), np.float32)
        np.add.at(self.z, (self.columns[what], who), weight)
        val, vec = np.linalg.eigh((self.z.T @ self.z).astype(float))
        self.root = vec * np.where(val > 1e-6, np.maximum(val, 1e-6) ** -0.5, 0)
        self.x = np.zeros((0, len(marks)))
        self.y = np.zeros(0)
        self.add(self.toxic, 1.0)
        self.add(clean, -1.0)

    def add(self, words: list[str], y: float) -> None:
        self.x = np.vstack([self.x, _kernel(words, self.columns, self.z) @ self.root])
        self.y = np.append(self.y, np.full(len(words), y))

    def model(self) -> Model:
        """The machine as subsequence weights."""
        w, bias = _svm(self.x, self.y, self.cost)
        weights = np.zeros(2 ** BITS, np.float32)
        weights[self.used] = self.z @ (self.root @ w)
        return Model(weights, bias)


def _words(batches):
    """id, toxic, its strings, and two minwise shingles, by which near copies are known."""
    for b in batches:
        texts = text_of(b.column(2))
        words = [[w for w in {plain(w) for w in words_of(x)} if 0 < len(w) <= 40] for x in texts]
        keys = [(int(x.min()), int((x * np.uint64(0x9E3779B97F4A7C15)).min())) if len(x) else (0, 0) for x in shingle_sets(b.column(2))]
        k = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(words, pa.list_(pa.string())), pa.array(k[:, 0]), pa.array(k[:, 1])],
                                         names=["doc_id", "toxic", "words", "k1", "k2"])


def _trainable(labels: DataFrame) -> DataFrame:
    ok = labels.where("doc_id is not null and toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("long").alias("toxic"))
    ok = ok.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != HELD_OUT).distinct()
    return stored(ok, "trainable")


def _sample(docs: DataFrame, ok: DataFrame) -> DataFrame:
    """doc_id, toxic, text of the labelled training texts that are learnt from."""
    pick = lambda y, n: ok.where(f"toxic = {y}").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(n)
    few = pick(1, SAMPLE_TOXIC).unionByName(pick(0, SAMPLE_CLEAN))  # a bounded number of ids
    return stored(docs.join(F.broadcast(few), "doc_id").select("doc_id", "toxic", "text"), "labelled")


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on ``labels`` (doc_id, toxic) of ``docs`` (doc_id, text), leaving out
    rows with crc32(doc_id) mod 3 = 1. Without toxic training texts every text
    gets the same low score."""
    small_batches(docs.sparkSession)
    ok = _trainable(labels)
    sample = _sample(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ok)
    texts = stored(sample.mapInArrow(_words, "doc_id long, toxic long, words array<string>, k1 long, k2 long"), "texts")
    for key in ("k1", "k2"):  # one of the texts that share it
        texts = texts.join(texts.groupBy(key).agg(F.min("doc_id").alias("doc_id")), [key, "doc_id"], "left_semi")
    words = stored(texts.select("toxic", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("toxic").alias("pos"), F.count(F.lit(1)).alias("n")), "words")
    total, pos, n_words = words.agg(F.sum("n"), F.sum("pos"), F.count(F.lit(1))).first()
    if not pos or pos == total:
        return _no_model()
    rate = float(pos / total)
    # parts of words (4 to 6 characters, with the marks) and whole words
    marked = words.select("word", "pos", "n", F.concat(F.lit("^"), "word", F.lit("$")).alias("m"))
    part = F.flatten(F.transform(F.array(F.lit(4), F.lit(5), F.lit(6)), lambda k: F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("m") - k + 1)), lambda i: F.substring(F.col("m"), i, k))))
    parts = marked.select("word", "pos", "n", F.explode(F.array_distinct(F.concat(part, F.array("m")))).alias("part"))
    sums = stored(parts.groupBy("part").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")), "parts")
    share = F.col("pos") / F.col("n")
    gain = F.col("pos") * F.log(share / rate) + F.when(F.col("pos") < F.col("n"), (F.col("n") - F.col("pos")) * F.log((1 - share) / (1 - rate))).otherwise(0)
    chance = float(np.log(max(n_words, 2))) + 2  # so that hardly a part in all gets here by chance
    strong = sums.where((share > 0.8) & (gain > chance)).orderBy(F.desc(gain), "part").limit(PARTS)
    hit = parts.where("pos > 0.8 * n").join(F.broadcast(strong.select("part")), "part").select("word", "pos").distinct()
    order = F.xxhash64("word", F.lit(5))
    toxic = [r.word for r in hit.orderBy(F.desc("pos"), order).limit(STRINGS // 2).collect()]
    other = words.where("pos <= 0.5 * n").select("word", order.alias("h"))
    clean = [r.word for r in other.orderBy("h").limit(STRINGS).collect()]
    if not toxic or not clean:
        return _no_model()
    machine, known = Machine(toxic, clean), set(clean)
    for _ in range(ROUNDS):
        model = machine.model()
        rated = other.mapInArrow(_rated(model), "word string, s double").where("s > -0.9").orderBy(F.desc("s"), "word").limit(HARD)
        hard = [r.word for r in rated.collect() if r.word not in known]
        if not hard:
            break
        known.update(hard)
        machine.add(hard, -1.0)
    model = machine.model()
    got = sample.mapInArrow(_worst(model, 1), _WORST_SQL).toPandas()
    y, x = got["id"].to_numpy(float), np.vstack([*got["worst"], np.zeros((0, WORST))])
    share = ok.where("toxic = 1").count() / ok.count()  # the sample has its own share of toxic texts
    w = np.where(y > 0, share / max(1e-9, y.mean()), (1 - share) / max(1e-9, 1 - y.mean()))
    coef = _logistic(x, y, w)
    return Model(model.weights, model.bias, tuple(coef[:-1].tolist()), float(coef[-1]))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Logistic regression with a weak prior; the last coefficient is the shift."""
    x = np.hstack([x, np.ones((len(x), 1))])
    coef = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        g = x.T @ (w * (p - y)) + 0.02 * coef
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(len(coef)), g)
        step *= min(1, 2 / max(1e-9, np.abs(step).max()))
        coef = coef - step
        if np.abs(step).max() < 1e-6:
            break
    return coef


def _rated(model: Model):
    def run(batches):
        for b in batches:
            words = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.strings(words), pa.float64())], names=["word", "s"])
    return run


_SEEN: dict = {}
_WORST_SQL = "id long, worst array<double>"


def _worst(model: Model, ids: int):
    """The highest scores of strings of each text; the text is the last column."""
    mark = hash((model.weights.tobytes(), model.bias))

    def run(batches):
        if _SEEN.get("model") != mark:
            _SEEN.clear()
            _SEEN.update(model=mark, words={})
        for b in batches:
            out, held, size = [], [], 0
            texts = text_of(b.column(b.num_columns - 1))
            for n, text in enumerate(texts, 1):
                held.append(words_of(text))
                size += len(text)
                if size >= 1_000_000 or n == len(texts):
                    seen = _SEEN["words"]
                    new = list(set().union(*held).difference(seen))
                    if len(seen) + len(new) > MEMORY:
                        seen.clear()
                        new = list(set().union(*held))
                    for i in range(0, len(new), TOGETHER):
                        seen.update(zip(new[i:i + TOGETHER], model.strings([plain(w) for w in new[i:i + TOGETHER]]).tolist()))
                    out += [(heapq.nlargest(WORST, map(seen.__getitem__, x)) + [NONE] * WORST)[:WORST] for x in held]
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([b.column(ids), pa.array(out, pa.list_(pa.float64()))], names=["id", "worst"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text; other columns are ignored) -> doc_id, held_out,
    score (0 to 1), predicted, a row per row, from the text alone. Null and empty
    texts score as texts without strings; null ids (held_out null) and repeated
    rows are rows like any other; empty table: empty result."""
    small_batches(docs.sparkSession)
    got = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_worst(model, 0), _WORST_SQL)
    z = sum((F.lit(a) * F.col("worst")[i] for i, a in enumerate(model.slopes)), F.lit(model.shift))
    chance = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))
    return got.select(F.col("id").alias("doc_id"), (F.crc32(F.col("id").cast("string").cast("binary")) % 3 == HELD_OUT).alias("held_out"),
                      chance.alias("score"), F.when(chance >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def _harmless(model: Model, text: int):
    worst = _worst(model, 0)

    def run(batches):
        for b in batches:
            got = next(worst(iter([pa.RecordBatch.from_arrays([b.column(text), b.column(text)], names=["id", "text"])])))
            w = np.array(got.column(1).to_pylist(), float).reshape(-1, WORST)
            z = np.clip(w @ np.array(model.slopes) + model.shift, -30, 30)
            yield b.filter(pa.array(1 / (1 + np.exp(-z)) < THRESHOLD))
    return run


def harmless(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not predicted toxic."""
    small_batches(docs.sparkSession)
    return docs.mapInArrow(_harmless(model, docs.columns.index("text")), docs.schema)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled rows of ``docs`` and score all of them."""
    return score(docs, fit(docs, labels))
