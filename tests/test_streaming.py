"""Stream forms equal the batch forms on closed windows."""

import os
import tempfile

from pyspark.sql import functions as F

from opinari.config import FIXTURE_SCORER
from opinari.operators import filters
from opinari.operators.sentiment import score_lexicon
from opinari.streaming import events as E

from conftest import SF_SMALL


def _as_dir(spark, table):
    """Stream sources read directories: land the small table in one."""
    path = tempfile.mkdtemp(prefix=f"opinari-{table}-")
    spark.read.parquet(f"{SF_SMALL}/{table}.parquet").write.mode("overwrite").parquet(path)
    return path


def _events_stream(spark):
    path = _as_dir(spark, "events")
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def _run_to_memory(df, name, mode="complete"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def test_event_rate_stream_equals_batch(spark):
    batch = E.event_rate(E.with_event_time(spark.read.parquet(f"{SF_SMALL}/events.parquet")))
    stream = _run_to_memory(E.event_rate(E.with_event_time(_events_stream(spark))), "rate_out")
    key = ["window", "event_type", "events"]
    assert sorted(batch.select(*key).collect()) == sorted(stream.select(*key).collect())


def test_error_ratio_and_alerts_per_batch(spark):
    ratios = E.error_ratio(E.with_event_time(spark.read.parquet(f"{SF_SMALL}/events.parquet")), "1 hour")
    a = E.alerts(ratios)
    assert set(a.columns) >= {"alert_id", "alert_type", "severity", "status", "created_at", "resolved_at"}
    stream = _run_to_memory(E.error_ratio(E.with_event_time(_events_stream(spark)), "1 hour"), "ratio_out")
    assert sorted(stream.collect()) == sorted(ratios.collect())


def test_alert_stream_writes_alerts_of_closed_windows(spark):
    base = tempfile.mkdtemp(prefix="opinari-e5-")
    ratios = E.error_ratio(E.with_event_time(_events_stream(spark)).withWatermark("ts", "10 minutes"), "1 hour")
    paths = [os.path.join(base, x) for x in ("ratios", "alerts", "ckpt")]
    E.alert_stream(ratios, *paths).awaitTermination()
    events = E.with_event_time(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    closed = E.error_ratio(events, "1 hour").where(F.col("window.end") <= events.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0])
    key = ["alert_id", "status", "peak_value"]
    assert sorted(map(str, spark.read.parquet(paths[1]).select(*key).collect())) == sorted(map(str, E.alerts(closed).select(*key).collect()))
    assert spark.read.parquet(paths[1]).count() > 0


def test_alert_runs_break_on_missing_windows(spark):
    rows = [("2024-01-01 00:00:00", 50.0), ("2024-01-01 01:00:00", 50.0), ("2024-01-01 11:00:00", 50.0), ("2024-01-01 12:00:00", 1.0)]
    df = spark.createDataFrame(rows, "s string, error_pct double").select(
        F.struct(F.to_timestamp("s").alias("start"), (F.to_timestamp("s") + F.expr("INTERVAL 1 HOUR")).alias("end")).alias("window"), "error_pct")
    got = sorted((r["alert_type"], str(r["created_at"]), str(r["resolved_at"])) for r in E.alerts(df).collect())
    assert [g[1:] for g in got if g[0] == "error_rate_high"] == [
        ("2024-01-01 00:00:00", "2024-01-01 02:00:00"), ("2024-01-01 11:00:00", "2024-01-01 12:00:00")]


def test_rate_follows_the_window(spark):
    e = E.with_event_time(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    for length, seconds in (("5 minutes", 300), ("1 hour", 3600)):
        r = E.event_rate(e, length).first()
        assert abs(r["rate_per_sec"] - r["events"] / seconds) < 1e-12


def test_quantiles_latest_state_quality_streams(spark):
    batch = E.with_event_time(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    out = _run_to_memory(E.latency_quantiles(E.with_event_time(_events_stream(spark)), approx=True), "quant_out")
    want = {(r["window"], r["event_type"]): r for r in E.latency_quantiles(batch, approx=True).collect()}
    assert {(r["window"], r["event_type"]): r for r in out.collect()} == want
    out = _run_to_memory(E.latest_state(E.with_event_time(_events_stream(spark))), "state_out")
    assert sorted(map(str, out.collect())) == sorted(map(str, E.latest_state(batch).collect()))
    path = _as_dir(spark, "documents")
    cols = [F.timestamp_millis(F.col("doc_id") * 60000).alias("created_at"), F.col("text").alias("cleaned_comment"),
            (F.col("doc_id") % 10 / 10.0).alias("sentiment_confidence")]
    docs = spark.read.parquet(path)
    stream = spark.readStream.schema(docs.schema).parquet(path).select(*cols)
    out = _run_to_memory(E.quality_over_time(stream), "quality_out")
    assert sorted(map(str, out.collect())) == sorted(map(str, E.quality_over_time(docs.select(*cols)).collect()))


def test_watermark_holds_back_open_windows(spark):
    s = E.windowed_counts_with_watermark(E.with_event_time(_events_stream(spark)))
    out = _run_to_memory(s, "wm_out", mode="append")
    events = E.with_event_time(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    border = events.agg(F.max("ts") - F.expr("INTERVAL 10 MINUTES")).first()[0]
    batch = events.groupBy(F.window("ts", "1 hour").alias("window"), "event_type").agg(F.count(F.lit(1)).alias("events"))
    assert sorted(out.collect()) == sorted(batch.where(F.col("window.end") <= border).collect())
    assert 0 < out.count() < batch.count()


def test_dedup_stream_equals_batch(spark):
    path = _as_dir(spark, "documents")
    docs = spark.read.parquet(path)
    stream = spark.readStream.schema(docs.schema).parquet(path)
    out = _run_to_memory(E.dedup_stream(stream.select("source", "text"), ["source", "text"]),
                         "dedup_out", mode="append")
    assert sorted(map(str, out.collect())) == sorted(map(str, docs.select("source", "text").distinct().collect()))


def test_incremental_scoring_writes_once(spark):
    base = tempfile.mkdtemp(prefix="opinari-e7-")
    src = os.path.join(base, "landing")
    from opinari.sources.tables import comments
    comments(spark, SF_SMALL).select("comment_id", "value").write.parquet(src)
    schema = spark.read.parquet(src).schema

    def transform(df):
        return score_lexicon(filters.comment_filter(df, "value"), FIXTURE_SCORER) \
            .select("comment_id", "sentiment", "sentiment_confidence")

    out, ckpt = os.path.join(base, "scored"), os.path.join(base, "ckpt")
    E.incremental_scoring(spark, src, schema, out, ckpt, transform).awaitTermination()
    n1 = spark.read.parquet(out).count()
    E.incremental_scoring(spark, src, schema, out, ckpt, transform).awaitTermination()
    n2 = spark.read.parquet(out).count()
    expected = transform(spark.read.parquet(src)).count()
    assert n1 == n2 == expected
