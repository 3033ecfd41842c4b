"""Report states of loads, merged, against the report over all rows."""

import tempfile

import pytest
from pyspark.sql import functions as F

from opinari.operators import quality as Q
from opinari.operators import report_state as R

ROWS = [(k, t, s, c, a) for k, (t, s, c, a) in enumerate([
    ("Good game, good fun. Play it!", "positive", 0.95, ["gameplay"]), ("", "unknown", 0.5, []), (None, "unknown", None, None),
    ("Bad art", "negative", 0.8, ["art", "price"]), ("ÄÖ ü 漢字 good", "positive", 0.71, ["art"]), ("x" * 1500, "negative", 0.2, []),
    ("game game game", "positive", 0.91, ["gameplay"]), ("short", "unknown", 0.5, []), ("tie tie bad", "negative", 0.66, ["price"])] * 5)]
SCHEMA = "id long, cleaned_comment string, sentiment string, sentiment_confidence double, detected_aspects array<string>"


def as_dict(df):
    rows = df.collect()
    out = {(r["section"], r["metric"]): None if r["value"] is None else round(r["value"], 9) for r in rows}
    assert len(out) == len(rows)
    return out


def test_three_loads_equal_their_union(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4, "id")
    table = tempfile.mkdtemp(prefix="opinari-report-") + "/t"
    for i in range(3):
        part = df.where(F.col("id") % 3 == i)
        assert R.add(part, table, f"day-{i}") and not R.add(part, table, f"day-{i}")      # a repeat changes nothing
    assert R.add(df.limit(0), table, "nothing")
    got, want = as_dict(R.report(R.merge(R.states(spark, table)))), as_dict(Q.quality_report(df))
    sketch = ("confidence", "median_confidence")
    assert abs(got.pop(sketch) - want.pop(sketch)) <= 0.05           # the values beside the middle lie 0.05 apart
    assert got == want
    # A merger is a state: merging mergers gives the same.
    some = R.states(spark, table)
    twice = R.merge(R.merge(some.where("load_id < 'day-1'")).union(R.merge(some.where("load_id >= 'day-1'"))))
    again = as_dict(R.report(twice))
    again.pop(sketch)
    assert again == want
    by_load = {r["load_id"]: r for r in R.history(spark, table).collect()}
    for i in range(3):
        part = df.where(F.col("id") % 3 == i)
        assert by_load[f"day-{i}"]["quality_score"] == pytest.approx(Q.quality_score(part).first()[0])
        assert by_load[f"day-{i}"]["record_count"] == part.count()
    assert by_load["nothing"]["quality_score"] is None


def test_a_report_reads_no_text(spark):
    table = tempfile.mkdtemp(prefix="opinari-report-") + "/t"
    R.add(spark.createDataFrame(ROWS, SCHEMA), table, "a")
    files = R.states(spark, table).inputFiles()
    assert files and all(table in f for f in files)


def test_columns_that_some_loads_lack_and_no_rows(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    both = R.merge(R.state(df).union(R.state(df.select("cleaned_comment"))))
    got = as_dict(R.report(both))
    assert got["sentiment", "total_analyzed"] == len(ROWS) and got["text", "total_texts"] == 2 * sum(r[1] is not None for r in ROWS)
    empty = df.limit(0)
    assert as_dict(R.report(R.merge(R.state(empty)))) == as_dict(Q.quality_report(empty))


def test_sketches_within_their_bounds(spark):
    df = spark.range(60_000).select(F.concat(F.lit("w"), "id", F.lit(" w"), F.col("id") % 777).alias("cleaned_comment"),
                                    (F.pmod(F.hash("id"), F.lit(1_000_003)) / 1_000_003).alias("sentiment_confidence"))
    whole = R.merge(R.state(df.where("id < 40000")).union(R.state(df.where("id >= 40000"))))
    got, exact = as_dict(R.report(whole, exact_words=False)), as_dict(R.report(whole))
    assert exact["language", "unique_words"] == 60_000
    assert got["language", "unique_words"] == pytest.approx(60_000, rel=0.04)
    below = df.where(F.col("sentiment_confidence") <= got["confidence", "median_confidence"]).count()
    assert abs(below / 60_000 - 0.5) <= 0.002
