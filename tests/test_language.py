"""Scoring in the text's row against the definition, texts over several portions, plan shape."""

import dataclasses
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opinari.operators import language

TRAIN = [("en", "the cat and the dog"), ("en", "this is the game"), ("de", "der hund und die katze"),
         ("de", "das spiel ist gut"), ("fr", "le chat et le chien \U0001F600\U0001F600 oui"), ("aa", "zzzyyy"), ("bb", "zzzyyy"),
         (None, "not used"), ("en", None)]


def grams(t):
    t = " ".join((t or "").split()).lower()
    return [t[i:i + 3] for i in range(len(t) - 2)]


def brute(text):
    counts, docs = {}, Counter(lang for lang, _ in TRAIN if lang)
    for lang, t in TRAIN:
        if lang:
            counts.setdefault(lang, Counter()).update(grams(t))
    v, n = len(set().union(*counts.values())), sum(docs.values())
    own = grams(text)
    if len((text or "").strip()) < 10:
        return "unknown"
    scores = [(math.log(docs[x] / n) - len(own) * math.log(sum(c.values()) + v) + sum(math.log(c[g] + 1) for g in own), x)
              for x, c in counts.items() if any(c[g] for g in own)]
    return max(scores)[1] if scores else "unknown"


TEXTS = ["the dog is here", "der hund ist gut", "le chien et le chat", "oui \U0001F600\U0001F600 oui oui", "zzzyyy zzzyyy", "short",
         "   the   ", None, "", "qqqqqqqqqqqq", "the cat\n\nand THE dog", "x" * 20 + "the", "das spiel ist gut"]


@pytest.fixture(scope="module")
def model(spark):
    return language.train(spark.createDataFrame(TRAIN, "lang string, text string"))


def found(df, model):
    return {r[0]: r[1] for r in language.detect_ids(df, model, "id", "text").collect()}


@pytest.mark.parametrize("path", ["row", "broadcast", "shuffle"])
def test_equal_to_the_definition(spark, model, path):
    most = language.PROFILE_BROADCAST_GRAMS
    m = dataclasses.replace(model, grams={"row": model.grams, "broadcast": most, "shuffle": most + 1}[path])
    assert language._in_row(m) == (path == "row")
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    assert found(df, m) == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_ties_go_to_the_later_name(spark, model):
    df = spark.createDataFrame([(1, "zzzyyy zzzyyy")], "id int, text string")
    assert found(df, model) == {1: "bb"}


@pytest.mark.parametrize("portion", [1, 2, 3, 7])
def test_portions_lose_and_repeat_no_trigram(monkeypatch, portion):
    monkeypatch.setattr(language, "PORTION", portion)
    texts = ["abcdefghij", None, "", "ab", "abc", "\U0001F600bécd" * 5]
    got = Counter()
    for numbers, row in language.portions(texts):
        got.update(zip(row.tolist(), language.gram_texts(numbers)))
    assert got == Counter((i, t[k:k + 3]) for i, t in enumerate(texts) for k in range(len(t or "") - 2))


def test_trigrams_on_the_jvm_agree(spark):
    t = "a\U0001F600\U0001F600bc\né"
    row = spark.createDataFrame([(t,)], "t string").select(language.trigrams_of(F.col("t"))).first()[0]
    assert row == [t[k:k + 3] for k in range(len(t) - 2)]


def test_a_text_longer_than_a_portion(spark, model):
    df = (spark.range(1).select("id", F.repeat(F.lit("der hund und die katze "), 120_000).alias("text")))
    assert df.select(F.length("text")).first()[0] > 2 * language.PORTION
    assert found(df, model) == {0: "de"}


def test_no_row_per_trigram_and_no_shuffle(spark, model):
    df = spark.createDataFrame([(1, "the cat and the dog", "x"), (1, "der hund und die katze", "y")], "id int, text string, detected string")
    out = language.detect(df, model, "id", "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan and "Join" not in plan
    assert plan.count("ArrowEvalPython") == 1
    # Repeated ids keep their own languages.
    assert sorted(r.detected_language for r in out.collect()) == ["de", "en"]
    assert out.columns == [*df.columns, "detected_language"]


def test_empty_tables(spark, model):
    none = spark.createDataFrame([], "id int, text string")
    assert found(none, model) == {}
    untrained = language.train(spark.createDataFrame([], "lang string, text string"))
    assert found(spark.createDataFrame([(1, "the cat and the dog")], "id int, text string"), untrained) == {1: "unknown"}
