"""J5 with large keyword tables, against every keyword in every text."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from opinari.operators import aspects, keywords
from opinari.operators.base import NumberTable, portions


def data(seed, n_texts, n_words):
    r = random.Random(seed)
    letters = "aabcdeé日 .%"
    texts = [(k % 40, "".join(r.choice(letters) for _ in range(r.randrange(0, 200)))) for k in range(n_texts)]
    texts += [(90, None), (91, ""), (92, "The SAME text"), (92, "The SAME text"), (93, "new\nline"), (94, "a" * 30_000)]
    words = {"", "a", "é", "aa", "w\nl", "same", "SAME", "text", "a" * 40, "zzz", "日", "e s"}
    while len(words) < n_words:
        words.add("".join(r.choice(letters) for _ in range(r.randrange(1, 9))))
    words = sorted(words)
    lexicon = [(f"a{k % 7}", w) for k, w in enumerate(words)] + [("other", "same"), ("none", None), ("a0", words[0]), ("a0", words[0])]
    return texts, lexicon


def expected(texts, lexicon):
    pairs = {x for x in lexicon if x[1] is not None}
    return Counter((i, a, w) for i, t in texts if t is not None for a, w in pairs if w in t.lower())


@pytest.mark.parametrize("limit", [keywords.MAX_BROADCAST, 0])
def test_both_ways_equal_every_pair(spark, monkeypatch, limit):
    monkeypatch.setattr(keywords, "MAX_BROADCAST", limit)
    texts, lexicon = data(4, 60, 3000)
    df = spark.createDataFrame(texts, "id long, cleaned_comment string")
    words = spark.createDataFrame(lexicon, "aspect string, keyword string")
    got = Counter(map(tuple, aspects.keyword_hits(df, words, "id").collect()))
    assert got == expected(texts, lexicon)


def test_a_hundred_thousand_keywords(spark):
    texts, lexicon = data(5, 40, 100_000)
    df = spark.createDataFrame(texts, "id long, cleaned_comment string")
    words = spark.createDataFrame(lexicon, "aspect string, keyword string")
    got = Counter(map(tuple, aspects.keyword_hits(df, words, "id").collect()))
    assert got == expected(texts, lexicon)


def test_small_and_empty_lexicons(spark):
    texts, lexicon = data(6, 20, 100)
    df = spark.createDataFrame(texts, "id long, cleaned_comment string")
    words = spark.createDataFrame(lexicon, "aspect string, keyword string")
    assert Counter(map(tuple, aspects.keyword_hits(df, words, "id").collect())) == expected(texts, lexicon)
    assert Counter(map(tuple, keywords.gram_hits(df, words, "id", "cleaned_comment").collect())) == expected(texts, lexicon)
    none = words.limit(0)
    for hits in (aspects.keyword_hits(df, none, "id"), keywords.gram_hits(df, none, "id", "cleaned_comment")):
        assert hits.columns == ["id", "aspect", "keyword"] and hits.count() == 0


def test_a_text_is_not_copied_per_gram(spark):
    df = spark.createDataFrame([(1, "one two three"), (2, None)], "id long, cleaned_comment string")
    words = spark.createDataFrame([("a", "two"), ("b", "two"), ("a", "three"), ("a", "fore"), ("a", "e")], "aspect string, keyword string")
    out = keywords.gram_hits(df, words, "id", "cleaned_comment")
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, out.collect())) == [(1, "a", "e"), (1, "a", "three"), (1, "a", "two"), (1, "b", "two")]


def test_number_table_and_portions():
    r = np.random.default_rng(1)
    numbers = np.unique(r.integers(-1 << 62, 1 << 62, 20_000))
    asked = np.concatenate([r.permutation(numbers), r.integers(-1 << 62, 1 << 62, 20_000), np.zeros(3, np.int64)])
    at = NumberTable(numbers).places(asked)
    known = np.isin(asked, numbers)
    assert (at >= 0).tolist() == known.tolist() and (numbers[at[known]] == asked[known]).all()
    assert NumberTable(numbers[:0]).places(asked).max() == -1
    assert list(portions(pa.array([5, None, 5, 30, 1, 1]), 10)) == [(0, 3), (3, 1), (4, 2)]
