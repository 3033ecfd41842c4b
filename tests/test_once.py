"""What is written or made once, and what is made by portions."""

import pyarrow as pa
from pyspark.sql import functions as F

from opinari.llm import decontam
from opinari.operators import ml, quality


def test_the_quality_report_cleans_its_texts_once(spark):
    df = spark.createDataFrame([("a  b. A!", "positive", 0.75), (None, "unknown", 0.0)], "raw string, sentiment string, sentiment_confidence double")
    out = quality.quality_report(df.select(F.regexp_replace("raw", " +", " ").alias("cleaned_comment"), "sentiment", "sentiment_confidence"))
    assert "regexp_replace" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {(r[0], r[1]): r[2] for r in out.collect()}
    assert got["language", "char_diversity"] == 5 / 7 and got["language", "total_words"] == 3
    assert got["text", "total_texts"] == 1 and got["top_words", "a"] == 2


def test_a_classifier_counts_its_terms_once(spark, monkeypatch):
    made, plain = [], ml.written
    monkeypatch.setattr(ml, "written", lambda df, name: made.append(name) or plain(df, name))
    df = spark.createDataFrame([("good fine", 1), ("bad", 0), ("fine", 1), ("bad worse", 0)], "text string, label int")
    got = ml.train_classifier(df).transform(df).select("prediction").collect()
    assert made == ["term-counts"] and got == ml.classifier_pipeline().fit(df).transform(df).select("prediction").collect()


class _Shared:
    value = decontam.Automaton([])


def test_spans_are_removed_by_portions():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["ab " * 200_000] * 5 + [None])], names=["doc_id", "text"])
    out = list(decontam._remover(_Shared, (1, None), 0.5)(iter([batch])))
    assert len(out) > 1 and pa.Table.from_batches(out).equals(pa.Table.from_batches([batch]).replace_schema_metadata(None))
