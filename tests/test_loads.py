"""Loads that break off and are repeated; the bucketed score table."""

import tempfile

import pytest
from pyspark.sql import functions as F

from opinari.config import FIXTURE_SCORER
from opinari.operators import sentiment
from opinari.sources import loads, scores, sinks


def table():
    return tempfile.mkdtemp(prefix="opinari-loads-") + "/t"


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_a_broken_load_leaves_nothing_and_can_be_repeated(spark):
    at = table()
    with pytest.raises(FileNotFoundError):
        loads.read(spark, at)
    day = spark.range(0, 1000, 1, 4).withColumn("g", F.col("id") % 3)
    broken = day.withColumn("g", F.when(F.col("id") == 900, F.raise_error(F.lit("lost"))).otherwise(F.col("g")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        loads.load(broken, at, "day-1", ("g",))
    with pytest.raises(FileNotFoundError):
        loads.read(spark, at)
    assert loads.load(day, at, "day-1", ("g",))
    assert not loads.load(day, at, "day-1", ("g",))
    assert ids(loads.read(spark, at)) == list(range(1000))


def test_broken_between_write_and_commit(spark, monkeypatch):
    at = table()
    loads.load(spark.range(10), at, "a")
    with monkeypatch.context() as m:
        m.setattr(loads, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("driver lost")))
        for _ in range(2):
            with pytest.raises(RuntimeError):
                loads.load(spark.range(10, 20), at, "b")
    assert ids(loads.read(spark, at)) == list(range(10))
    assert loads.load(spark.range(10, 20), at, "b")
    out = loads.read(spark, at, load_column="from_load")
    assert ids(out) == list(range(20))
    assert {r["from_load"]: r["count"] for r in out.groupBy("from_load").count().collect()} == {"a": 10, "b": 10}


def test_two_commits_of_one_load_count_once(spark):
    at = table()
    for attempt in ("x1", "x2"):
        spark.range(5).write.parquet(loads._staged(at, "a", attempt))
        loads._commit(spark, at, "a", attempt, spark.range(5).schema, ())
    assert loads.commits(spark, at).count() == 1 and ids(loads.read(spark, at)) == list(range(5))


def test_new_columns_and_refused_names(spark):
    at = table()
    loads.load(spark.range(3), at, "a")
    loads.load(spark.range(3, 5).withColumn("more", F.lit("x")), at, "b")
    assert sorted((r["id"], r["more"]) for r in loads.read(spark, at).collect()) == [(0, None), (1, None), (2, None), (3, "x"), (4, "x")]
    for bad in ("", "a/b", "a=b"):
        with pytest.raises(ValueError):
            loads.load(spark.range(1), at, bad)
    with pytest.raises(ValueError):
        loads.load(spark.range(1).withColumn("Attempt", F.lit(1)), at, "c")
    loads.load(spark.range(1).withColumn("more", F.lit(1)), at, "d")
    with pytest.raises(ValueError):
        loads.read(spark, at)


def test_layers_and_once(spark):
    base = tempfile.mkdtemp(prefix="opinari-lake-")
    day = spark.range(20).withColumn("game_id", F.col("id") % 2)
    for _ in range(3):
        raw = sinks.load_raw(day, base, "2024-01-01", load_id="raw-2024-01-01")
        processed = sinks.load_processed(day, base, "clean", "2024-01-01", ("game_id",), load_id="clean-2024-01-01")
        curated = sinks.load_curated(spark, day, base, "games", load_id="games-2024-01-01")
    assert ids(loads.read(spark, raw)) == ids(loads.read(spark, processed)) == ids(loads.read(spark, curated)) == list(range(20))
    assert loads.read(spark, processed).select("processing_type", "load_date", "game_id").distinct().count() == 2
    profiles = loads.read(spark, f"{base}/curated/_profiles")
    assert profiles.groupBy("load_id").count().count() == 1
    at = table()
    assert ids(loads.once(spark, spark.range(4), at)) == ids(loads.once(spark, spark.range(9), at)) == [0, 1, 2, 3]


def test_score_table_is_not_shuffled(spark):
    at = table()
    name = scores.open_scores(spark, at, 4)

    def score(df, text_col):
        return sentiment.score_lexicon(df, FIXTURE_SCORER, text_col)

    texts = spark.range(0, 60).select("id", F.concat(F.lit("good text "), (F.col("id") % 40).cast("string")).alias("cleaned_comment"))
    scores.append_scores(spark, name, texts.where("id < 25"), score, buckets=4)
    scores.append_scores(spark, name, texts, score, buckets=4)
    scores.append_scores(spark, name, texts, score, buckets=4)
    assert spark.table(name).count() == spark.table(name).select("text_key").distinct().count() == 40
    more = texts.union(spark.createDataFrame([(99, "new text"), (98, None)], texts.schema))
    left = sentiment.unscored(more, spark.table(name))
    assert [r["id"] for r in left.collect()] == [99] and sentiment.already_scored(more, spark.table(name)).count() == 60
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = sentiment.unscored(texts, spark.table(name))._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One exchange, of the increment; the scan of the score table stands after it in the plan's text.
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("Bucketed: true")
    # Another session only needs the folder.
    again = scores.open_scores(spark.newSession(), at, 4)
    assert again == name
