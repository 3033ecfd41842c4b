"""T7 in the row and by join: equal results, repeated ids, nulls, plan shape."""

import pytest
from pyspark.sql import functions as F

from opinari.operators import lemma

ROWS = [(1, ["games", "game", "boxes", "cats", None, "games"]), (2, ["box", "boxes", "é\U0001F600s"]), (3, []), (4, None),
        (5, ["cat", "cats"] * 300), (6, ["glass", "glas", "women"])]
WANT = {1: ["game", "game", "box", "cat", None, "game"], 2: ["box", "box", "é\U0001F600s"], 3: [], 4: [], 5: ["cat"] * 600}


@pytest.mark.parametrize("in_row", [0, 100])
def test_in_the_row_and_by_join(spark, monkeypatch, in_row):
    monkeypatch.setattr(lemma, "IN_ROW", in_row)
    df = spark.createDataFrame(ROWS, "id int, toks array<string>")
    out = lemma.lemmatize(df, "id", "toks", "lem")
    got = {r["id"]: r["lem"] for r in out.collect()}
    assert {k: got[k] for k in WANT} == WANT
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert ("Exchange" not in plan and "Generate" not in plan) == (in_row > 0)


def test_no_lemmas_and_empty_table(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id int, toks array<string>")
    assert {r["id"]: r["lem"] for r in lemma.lemmatize(df, "id", "toks", "lem").collect()} == {1: ["a", "b"], 2: []}
    assert lemma.lemmatize(df.limit(0), "id", "toks", "lem").count() == 0


def test_repeated_ids_keep_their_tokens(spark):
    df = spark.createDataFrame([(1, ["cats"]), (1, ["cat", "dogs"]), (1, ["dog"])], "id int, toks array<string>")
    assert sorted(r["lem"] for r in lemma.lemmatize(df, "id", "toks", "lem").collect()) == [["cat"], ["cat", "dog"], ["dog"]]


def test_a_filter_does_not_repeat_the_lookup(spark):
    df = spark.createDataFrame([(i, f"Two cats and {i} cat") for i in range(20)], "comment_id int, value string")
    out = lemma.deep_clean(df).where(F.length("cleaned_comment") > 3).where(F.col("cleaned_comment").contains("cat"))
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert out.count() == 20 and "cats" not in out.first()["cleaned_comment"]


def test_the_lookup_goes_by_portions(spark, monkeypatch):
    monkeypatch.setattr(lemma, "PORTION", 3)
    df = spark.createDataFrame(ROWS * 3, "id int, toks array<string>").coalesce(1)
    got = lemma.lemmatize(df, "id", "toks", "lem").collect()
    assert len(got) == 3 * len(ROWS) and all(r["lem"] == WANT[r["id"]] for r in got if r["id"] in WANT)
