"""Sliding windows from panes against windows over every event."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from opinari.streaming import events as E
from opinari.streaming.panes import micros, pane_length, sliding_sums


def made(spark, n=2000):
    r = random.Random(7)
    start = dt.datetime(2024, 2, 28, 23, 0)
    rows = [(k, start + dt.timedelta(microseconds=r.randrange(6 * 3600 * 10**6)), r.choice(["a", "b", "error", None])) for k in range(n)]
    rows += [(n, None, "a"), (n + 1, start, "a"), (n + 2, start + dt.timedelta(minutes=60), "error")] + [(n + 3, start, "a")] * 3
    return spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string")


def plain(df, *cols):
    return sorted((str(r["window"]["start"]), str(r["window"]["end"]), *[r[c] for c in cols]) for r in df.collect())


@pytest.mark.parametrize("duration,slide", [("1 hour", "1 minute"), ("1 hour", "25 minutes"), ("90 minutes", "1 hour"),
                                            ("7 seconds", "3 seconds"), ("1 hour", "1 hour")])
def test_equal_to_window(spark, duration, slide):
    df = made(spark)
    if duration == "7 seconds":
        df = df.limit(300)
    want = df.groupBy(F.window("ts", duration, slide).alias("window"), "event_type").agg(F.count(F.lit(1)).alias("events"))
    got = E.event_rate(df, duration, slide)
    key = lambda d: sorted(((str(r["window"]["start"]), str(r["window"]["end"]), str(r["event_type"]), r["events"]) for r in d.collect()))
    assert key(got) == key(want)
    seconds = micros(duration) / 1e6
    assert all(r["rate_per_sec"] == pytest.approx(r["events"] / seconds) for r in got.limit(50).collect())
    ratio = df.groupBy(F.window("ts", duration, slide).alias("window")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "error").alias("errors"))
    assert plain(E.error_ratio(df, duration, slide=slide), "events", "errors") == plain(ratio, "events", "errors")


def test_quality_with_a_slide(spark):
    df = made(spark).select(F.col("ts").alias("created_at"), F.when(F.col("event_id") % 3 == 0, "").otherwise("long enough text").alias("cleaned_comment"),
                            (F.col("event_id") % 10 / 10).alias("sentiment_confidence"))
    from opinari.operators.quality import quality_score_expr
    want = df.groupBy(F.window("created_at", "1 hour", "10 minutes").alias("window")).agg(
        F.count(F.lit(1)).alias("record_count"), F.round(quality_score_expr(df), 9).alias("q"))
    got = E.quality_over_time(df, "1 hour", slide="10 minutes").withColumn("q", F.round("quality_score", 9))
    assert plain(got, "record_count", "q") == plain(want, "record_count", "q")


def test_copies_are_made_of_panes(spark):
    """60 windows of an hour: the copying expand stands above the aggregate of the events."""
    df = spark.range(100_000).select(F.timestamp_seconds(F.col("id") % 7200).alias("ts"))
    panes = df.groupBy(F.window("ts", pane_length("1 hour", "1 minute"))).count()
    assert panes.count() == 120
    plan = sliding_sums(df, "1 hour", "1 minute", {"n": F.count(F.lit(1))})._jdf.queryExecution().executedPlan().toString()
    copies = plan.index("Expand") if "Expand" in plan else plan.index("Generate")
    assert copies < plan.index("Range") and plan.count("HashAggregate", copies) >= 2


def test_stream_in_append_mode(spark, tmp_path):
    df = made(spark, 600).where("ts is not null")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")).withWatermark("ts", "0 seconds")
    query = E.error_ratio(stream, "1 hour", slide="20 minutes").writeStream.format("parquet").option("path", str(tmp_path / "out")) \
        .option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    got = plain(spark.read.parquet(str(tmp_path / "out")), "events", "errors")
    want = plain(E.error_ratio(df, "1 hour", slide="20 minutes"), "events", "errors")
    assert got and got == want[:len(got)]


def test_durations():
    assert micros("1 hour 30 minutes") == 5400 * 10**6 and pane_length("1 hour", "25 minutes") == f"{300 * 10**6} microseconds"
    for bad in ("1 month", "", "soon", "5"):
        with pytest.raises(ValueError):
            micros(bad)
    with pytest.raises(ValueError):
        pane_length("1 minute", "1 hour")
