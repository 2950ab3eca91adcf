"""What a task holds, and what archives store on the way."""

import tracemalloc

import numpy as np

from starloom.llm import toxicity, warc


def test_scores_of_many_and_long_words_in_little_memory():
    model = toxicity.Model(np.random.default_rng(1).normal(size=2 ** toxicity.BITS).astype(np.float32), -0.5)
    words = [f"word{i * 7919}x" for i in range(20_000)] + ["long" * 20_000, "", "a"]
    tracemalloc.start()
    got = model.strings(words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    for i in (0, 777, 19_999, 20_000, 20_001, 20_002):  # all subsequences of a string at once
        who, what, weight = toxicity.features([words[i]])
        assert got[i] == np.bincount(who, model.weights[what] * weight, 1)[0] - 0.5
    assert len(model.strings([])) == 0


def test_whole_archives_take_no_jumps(spark, monkeypatch):
    shape = "file string, start long, next long"
    whole = [("a", 0, 10), ("a", 10, 25), ("a", 25, 40), ("b", 0, 7)]
    jumped, links = [], warc._jumped
    monkeypatch.setattr(warc, "_jumped", lambda c: jumped.append({r.file for r in c.collect()}) or links(c))
    assert sorted(map(tuple, warc.reachable(spark.createDataFrame(whole, shape)).collect())) == [("a", 0), ("a", 10), ("a", 25), ("b", 0)]
    assert not jumped
    # a record within a payload (c), and a file that doesn't start with one (d)
    more = [("c", 0, 30), ("c", 12, 20), ("c", 20, 30), ("c", 30, 45), ("d", 3, 9), ("d", 9, 12)]
    got = sorted(map(tuple, warc.reachable(spark.createDataFrame(whole + more, shape)).collect()))
    assert got == [("a", 0), ("a", 10), ("a", 25), ("b", 0), ("c", 0), ("c", 30)] and jumped == [{"c", "d"}]
    assert warc.reachable(spark.createDataFrame([], shape)).collect() == []
