"""Most frequent values from bounded summaries against counting every value."""

import random
from collections import Counter

import pytest

from opinari.operators import frequent as H


def made(spark, words):
    return spark.createDataFrame([(w,) for w in words], "word string").repartition(6)


def want(words, n):
    return sorted(Counter(w for w in words if w is not None).items(), key=lambda x: (-x[1], x[0]))[:n]


def got(df):
    return [(r["word"], r["count"]) for r in df.collect()]


def natural(seed, n=40_000, types=30_000):
    r = random.Random(seed)
    return [f"w{int(types ** r.random())}" for _ in range(n)]


@pytest.mark.parametrize("n,tracked", [(10, 64), (10, 4096), (1, 8), (100, 128)])
def test_against_counting(spark, n, tracked):
    words = natural(n) + [None] * 50
    assert got(H.most_frequent(made(spark, words), "word", n, tracked)) == want(words, n)


def test_without_frequent_words_and_ties(spark, monkeypatch):
    """No word stands out: nothing can be proven, so all are counted."""
    calls = []
    count = H._counted
    monkeypatch.setattr(H, "_counted", lambda v, c: calls.append(v) or count(v, c))
    words = [f"w{i % 9000}" for i in range(27_000)]
    assert got(H.most_frequent(made(spark, words), "word", 5, 16, 1024)) == want(words, 5)
    assert len(calls) == 3                                    # 16, 256 and every word
    same = ["b", "a", "c", "a", "b", "c"]
    assert got(H.most_frequent(made(spark, same), "word", 2)) == [("a", 2), ("b", 2)]
    assert got(H.most_frequent(made(spark, same), "word", 9)) == [("a", 2), ("b", 2), ("c", 2)]
    assert got(H.most_frequent(made(spark, [None]), "word", 3)) == [] == got(H.most_frequent(made(spark, same).limit(0), "word", 3))


def test_the_vocabulary_is_not_shuffled(spark, monkeypatch):
    """Frequent words among many rare ones are proven by the first summary: only candidates are counted."""
    words = [f"top{i}" for i in range(10) for _ in range(3000 - i)] + [f"rare{i}" for i in range(60_000)]
    sizes = []
    keep = H.written
    monkeypatch.setattr(H, "written", lambda df, name: sizes.append((out := keep(df, name)).count()) or out)
    assert got(H.most_frequent(made(spark, words), "word", 10, 256)) == want(words, 10)
    assert len(sizes) == 1 and sizes[0] <= 256


def test_a_bound_that_holds(spark):
    """What a summary did not return occurs no more often than it says."""
    from pyspark.sql import functions as F
    for seed in range(3):
        words = natural(seed, 20_000, 10_000)
        for tracked in (16, 64, 512):
            total, found = made(spark, words).agg(F.count(F.lit(1)), F.expr(f"approx_top_k(word, {tracked}, {tracked})")).first()
            names = {r["item"] for r in found}
            worst = max((c for w, c in Counter(words).items() if w not in names), default=0)
            assert worst <= H._missed(total, tracked, found)
