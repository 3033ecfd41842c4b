"""Properties of the table operators, sinks and model jobs."""

import os

import pytest
from pyspark.sql import functions as F

from opinari.config import FIXTURE_LEXICON, FIXTURE_SCORER
from opinari.operators import dedup, filters, ml, quality
from opinari.plans import jobs
from opinari.sources import files, sinks
from opinari.sources.tables import comments, read_table, with_global_rank

from conftest import SF_SMALL


def test_w1_idempotent_and_first(spark):
    d = read_table(spark, SF_SMALL, "documents").select("doc_id", "source", "text")
    once = dedup.dedup_first(d, ["source", "text"], "doc_id")
    twice = dedup.dedup_first(once, ["source", "text"], "doc_id")
    assert sorted(once.collect()) == sorted(twice.collect())
    rows = spark.createDataFrame([(1, "g", None), (2, "g", None), (3, "g", "x")], "id int, g string, t string")
    kept = sorted(r.id for r in dedup.dedup_first(rows, ["g", "t"], "id").collect())
    assert kept == [1, 3]


def test_quality_score_bounds_and_empty(spark):
    s = jobs.batch_inference(filters.comment_filter(comments(spark, SF_SMALL)), "both")
    v = quality.quality_score(s).first()[0]
    assert 0 <= v <= 100
    empty = s.limit(0)
    assert quality.quality_score(empty).first()[0] is None
    prof = quality.text_length_profile(empty).first()
    assert prof["total_texts"] == 0


def test_aspect_summary_adds_up(spark):
    c = comments(spark, SF_SMALL)
    summ = jobs.aspect_summary_job(c, FIXTURE_LEXICON, FIXTURE_SCORER).collect()
    for r in summ:
        assert r.total_comments == r.positive_count + r.negative_count + r.unknown_count
        assert abs(r.positive_percentage + r.negative_percentage - 100.0) < 1e-9 or r.unknown_count > 0
    order = [r.aspect for r in summ]
    assert order == [n for n in FIXTURE_LEXICON.names if n in order]


def test_split_covers_every_row_once(spark):
    d = read_table(spark, SF_SMALL, "documents").select("doc_id")
    s = ml.assign_split(d, "doc_id")
    assert s.count() == d.count()
    assert set(r.split for r in s.select("split").distinct().collect()) <= {"train", "validation", "test"}
    again = ml.assign_split(d, "doc_id")
    assert sorted(s.collect()) == sorted(again.collect())


def test_weighted_metrics_edges(spark):
    perfect = spark.createDataFrame([(0, 0), (1, 1), (1, 1)], "label int, prediction int")
    m = ml.weighted_metrics(perfect).first()
    assert (m.accuracy, m.precision, m.recall, m.f1_score) == (1.0, 1.0, 1.0, 1.0)
    never = spark.createDataFrame([(0, 1), (1, 1), (1, 1)], "label int, prediction int")
    m = ml.weighted_metrics(never).first()
    # class 0 is never predicted: its precision is 0, weighted by support 1 of 3
    assert abs(m.precision - (2 / 3) * (2 / 3)) < 1e-12
    assert abs(m.accuracy - 2 / 3) < 1e-12


def test_ml_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    d = spark.createDataFrame([(0.0, 0.0), (1.0, 1.0), (1.0, 0.0), (0.0, 0.0), (1.0, 1.0)],
                              "label double, prediction double")
    m = ml.weighted_metrics(d).first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    assert abs(ev.evaluate(d, {ev.metricName: "weightedPrecision"}) - m.precision) < 1e-12
    assert abs(ev.evaluate(d, {ev.metricName: "weightedRecall"}) - m.recall) < 1e-12
    assert abs(ev.evaluate(d, {ev.metricName: "f1"}) - m.f1_score) < 1e-12


def test_python_model_udf_fallback(spark):
    from opinari.operators.sentiment import model_scorer_udf, score_with_model

    def load():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise ValueError("bad text")
            return [("positive", 0.9) for _ in texts]
        return predict

    df = spark.createDataFrame([("good",), ("boom",), ("",), (None,)], "cleaned_comment string")
    out = score_with_model(df, model_scorer_udf(load)).collect()
    got = [(r.sentiment, r.sentiment_confidence) for r in out]
    assert got == [("positive", 0.9), ("unknown", 0.0), ("unknown", 0.0), ("unknown", 0.0)]


def test_sinks_and_layers(spark, scratch):
    c = comments(spark, SF_SMALL).select("comment_id", "game_id", "value")
    p = os.path.join(scratch, "once")
    first = sinks.materialise_once(spark, c, p)
    second = sinks.materialise_once(spark, c.limit(1), p)
    assert first.count() == second.count() == c.count()
    base = os.path.join(scratch, "lake")
    raw = sinks.load_raw(c, base, "2024-01-01")
    proc = sinks.load_processed(c, base, "clean", "2024-01-02", partition_by=("game_id",))
    cur = sinks.load_curated(spark, c, base, "comments")
    assert spark.read.parquet(raw).filter("ingest_date = '2024-01-01'").count() == c.count()
    assert spark.read.parquet(proc).count() == c.count()
    assert spark.read.parquet(cur).count() == c.count()
    cat = sinks.catalog_append(spark, base, "raw", raw)
    assert cat.first().file_size > 0
    listing = files.list_layer(spark, raw)
    assert listing.count() >= 1 and "content" not in listing.columns
    csv_path = os.path.join(scratch, "csv")
    with_arrays = c.withColumn("arr", F.array(F.lit("a"), F.lit("b")))
    files.write_csv(with_arrays, csv_path)
    back = (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .csv(csv_path))
    assert back.count() == c.count()
    assert back.filter(F.col("arr") == '["a","b"]').count() == c.count()


def test_model_store(spark, scratch):
    d = ml.assign_split(read_table(spark, SF_SMALL, "documents").join(
        read_table(spark, SF_SMALL, "labels"), "doc_id").withColumnRenamed("quality", "label"), "doc_id")
    model = ml.train_classifier(d, 0.0, 5)
    path = sinks.save_model(spark, model, scratch, "tfidf", "v1", ml.evaluate(model, d))
    again = sinks.load_model(path)
    assert again.transform(d).count() == d.count()
    reg = spark.read.parquet(os.path.join(scratch, "models", "_registry")).first()
    assert reg.model_name == "tfidf" and reg.accuracy is not None


def test_required_columns():
    import pytest
    from opinari.schemas import require_columns

    class Fake:
        columns = ["a"]
    with pytest.raises(ValueError):
        require_columns(Fake(), "a", "b")


def test_detect_broadcast_and_shuffle_paths_agree(spark):
    import dataclasses

    from opinari.operators import language
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = language.train(docs, "text", "lang")
    assert model.grams <= language.PROFILE_BROADCAST_GRAMS
    big = dataclasses.replace(model, grams=language.PROFILE_BROADCAST_GRAMS + 1)
    texts = docs.select("doc_id", "text")
    a = {r[0]: r[1] for r in language.detect_ids(texts, model, "doc_id", "text").collect()}
    b = {r[0]: r[1] for r in language.detect_ids(texts, big, "doc_id", "text").collect()}
    assert a == b and len(a) == docs.count()
    assert sum(v == "unknown" for v in a.values()) < len(a)
    full = language.detect(texts, model, "doc_id", "text")
    assert full.columns == ["doc_id", "text", "detected_language"] and full.count() == len(a)
    plan = language.detect_ids(texts, model, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("n", [0, 1, 20, 1000, 5000, 300_000])
def test_rank_at_any_size(spark, n):
    df = spark.range(n).select(F.format_string("k%08d", F.col("id") * 7).alias("name"), (F.col("id") + 1).alias("want"))
    out = with_global_rank(df, "name")
    assert out.count() == n and out.where("rank != want").count() == 0
    assert out.columns == ["name", "want", "rank"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hashed_plans_have_no_sort_aggregate(spark):
    from opinari.operators.quality import table_profile
    from opinari.streaming.events import latest_state
    d = read_table(spark, SF_SMALL, "documents")
    e = read_table(spark, SF_SMALL, "events")
    for df in (dedup.dedup_first(d, ["source", "text"], "doc_id"), table_profile(d), latest_state(e)):
        assert "SortAggregate" not in _plan(df)


def test_xml_pages_with_many_items(spark):
    def item(g, ids, total=None):
        rows = "".join(f'<comment id="{i}" value="v{i}"/>' for i in ids)
        return f'<item id="{g}"><comments totalitems="{total or len(ids)}">{rows}</comments></item>'
    pages = spark.createDataFrame([
        (1, f"<items>{item('a', [1, 2])}{item('b', [3])}</items>"), (2, f"<items>{item('c', [4])}</items>"),
        (3, "<items><item id='d'><comments"), (4, None), (5, f"<items>{item('e', [], 7)}</items>"), (6, "no xml"),
        (7, "<items></items>")], "page long, payload string")
    got = sorted((r["game_id"], r["comment_id"] or 0, r["declared_total"]) for r in files.parse_comment_pages(pages).collect())
    assert got == [("a", 1, 2), ("a", 2, 2), ("b", 3, 1), ("c", 4, 1), ("e", 0, 7)]
    assert sorted(r["page"] for r in files.corrupt_pages(pages).collect()) == [3, 4, 6, 7]
    games = spark.createDataFrame([(
        '<items><item id="1"><name value="A"/><statistics><ratings><ranks><rank value="9"/></ranks></ratings></statistics></item>'
        '<item id="2"/><item id="3"><name value="C"/></item></items>',), ("<items><item",)], "payload string")
    got = sorted(tuple(r) for r in files.parse_game_pages(games).collect())
    assert got == [("1", "A", "9"), ("2", "Unknown", "0"), ("3", "C", "0")]


def test_landed_pages_and_reconciliation(spark, scratch):
    at = os.path.join(scratch, "pages")
    os.makedirs(at)
    for k in range(3):
        with open(os.path.join(at, f"p{k}.xml"), "w") as f:
            f.write(f'<items>\n<item id="g"><comments totalitems="6"><comment id="{k}" value="x"/></comments></item></items>' if k else "<items><")
    pages = files.read_pages(spark, at)
    page = F.regexp_extract("path", "p([0-9]+)", 1).cast("long")
    parsed = files.parse_comment_pages(pages.withColumn("page", page))
    assert sorted(r["comment_id"] for r in parsed.collect()) == [1, 2]
    assert files.corrupt_pages(pages).count() == 1
    totals = spark.createDataFrame([("g", 6), ("lost", 2)], "game_id string, declared_total long")
    got = {r["game_id"]: (r["expected_pages"], r["pages_landed"], r["missing_pages"], r["complete"])
           for r in files.page_reconciliation(parsed, totals, 2).collect()}
    assert got == {"g": (3, 2, 1, False), "lost": (1, 0, 1, False)}


CLEANING = [(1, "g", "we played this game and really enjoyed every part of it"), (2, "g", "same   words here my friends"),
            (3, "g", "same words here my friends"), (4, "g", "words [IMG]picture here[/IMG] stay outside block tags"),
            (5, "g", "das ist kein englischer Satz"), (6, "g", None), (7, "g", ""), (8, "h", "same words here my friends")]


def test_clean_job_chain(spark):
    rows = spark.createDataFrame([(i, g, None, "7", t) for i, g, t in CLEANING],
                                 "comment_id long, game_id string, username string, rating string, value string")

    def detect(df):
        return df.withColumn("detected_language", F.when(F.col("cleaned_comment").contains("englischer"), "de").otherwise("en"))

    got = {r["comment_id"]: r["cleaned_comment"] for r in jobs.clean_job(rows, detect).collect()}
    assert set(got) == {1, 2, 4, 8}             # spacing twins are one; stop-word-free English stays
    assert "played" in got[1] and "picture" in got[4]
    with pytest.raises(ValueError):
        jobs.clean_job(rows)
    light = jobs.light_clean(rows).where("comment_id = 7").first()
    assert light["cleaned_comment"] is None


def test_null_text_scores(spark):
    from opinari.operators import sentiment
    df = spark.createDataFrame([(1, None), (2, "that with"), (3, "that with")], "id long, cleaned_comment string")
    out = {r["id"]: (r["sentiment"], r["sentiment_confidence"]) for r in sentiment.score_distinct(
        df, lambda d, c: sentiment.score_lexicon(d, FIXTURE_SCORER, c)).collect()}
    assert out[1] == ("unknown", 0.0) and out[2] == out[3] and out[2][0] == "positive"
    none = spark.createDataFrame([], sentiment.SCORE_TABLE)
    assert [r["id"] for r in sentiment.unscored(df.where("id < 3"), none).collect()] == [2]


def test_model_runs_once_under_a_filter(spark):
    from opinari.operators.sentiment import model_scorer_udf, score_with_model
    df = spark.createDataFrame([("good",)], "cleaned_comment string")
    out = score_with_model(df, model_scorer_udf(lambda: lambda t: [("positive", 0.9)] * len(t))).where("sentiment = 'positive'")
    assert _plan(out).count("ArrowEvalPython") == 1 and out.count() == 1


def test_catalog_size_is_the_loads_own(spark, scratch):
    base = os.path.join(scratch, "catalog-lake")
    df = spark.range(1000)
    for day in ("2024-01-01", "2024-01-02"):
        path = sinks.load_raw(df, base, day)
        cat = sinks.catalog_append(spark, base, "raw", f"{path}/ingest_date={day}")
    sizes = [r["file_size"] for r in cat.collect()]
    assert len(sizes) == 2 and abs(sizes[0] - sizes[1]) < 0.1 * max(sizes)


def test_select_model_returns_the_best(spark):
    d = ml.assign_split(read_table(spark, SF_SMALL, "documents").join(
        read_table(spark, SF_SMALL, "labels"), "doc_id").withColumnRenamed("quality", "label"), "doc_id")
    train, held = d.where("split = 'train'"), d.where("split != 'train'")
    model, metrics = ml.select_model(train, held, (0.0, 0.1), 5)
    rows = metrics.collect()
    assert sum(r["is_best"] for r in rows) == 1 and len(rows) == 2
    best = next(r for r in rows if r["is_best"])
    again = ml.weighted_metrics(model.transform(held)).first()
    assert abs(again["f1_score"] - best["f1_score"]) < 1e-9
    assert best["f1_score"] == max(r["f1_score"] for r in rows)
    assert "last_updated" in ml.with_updated(metrics).columns


def test_user_rules(spark):
    df = spark.createDataFrame([(["plain_a"], "both", "x")], "aspects array<string>, kind string, user string")
    out = filters.aspect_request_failures(df, "aspects", "kind", FIXTURE_LEXICON, {"blocked_user": F.col("user") == "x"})
    assert out.first()["failed_rules"] == ["blocked_user"]
    t = spark.createDataFrame([("abc", 0.9, ["a"])], "cleaned_comment string, sentiment_confidence double, detected_aspects array<string>")
    rows = quality.quality_metric_rows(spark, t, extra_metrics={"texts": F.count(F.lit(1))}).collect()
    assert {r["metric_name"]: r["value"] for r in rows}["texts"] == 1.0


def test_extraction_check_without_columns(spark):
    r = quality.validate_extraction(spark.createDataFrame([("a",)], "username string")).first()
    assert not r["has_required_columns"] and not r["is_valid"] and "missing_columns" in r["errors"] and r["unique_games"] is None


def test_join_hot_equals_join(spark):
    from opinari.operators.base import join_hot
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 10 == 1, F.lit(None))
                                    .otherwise(F.col("id")).cast("string").alias("k"))
    right = left.where("k is not null and id % 7 < 5").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("v"))
    want = sorted(map(str, left.join(right.select("k", "v"), "k", "left").select("id", "k", "v").collect()))
    for total in (3000, 10_000 * 50):
        assert sorted(map(str, join_hot(left, right, "k", "n", total).collect())) == want
