"""Event-time operators.

E1–E4 and E6 are plain functions of a DataFrame: the same code runs on a
batch table or on a ``readStream`` source (add a watermark first for append
mode). E5 needs an ordered look-back over closed windows, so its stream form
(``alert_stream``) recomputes from the table of closed windows. E7–E9 are the Structured Streaming
jobs: incremental scoring with a checkpoint, duplicate removal across
arrivals, and late data under a watermark.

Deviations from the PromQL panels they re-aim: E1 counts event rows (PromQL
extrapolates a counter), and E2 is an exact quantile on tables and one with
bounded state on streams (PromQL interpolates in histogram buckets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinari.config import ALERT_RULES, AlertRule
from opinari.operators.quantiles import exact_quantiles
from opinari.streaming.panes import sliding_sums


def with_event_time(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """``timestamp_ntz`` → ``timestamp`` (watermarks need the latter); with
    the session time zone set to UTC the wall-clock values are unchanged."""
    return df.withColumn(ts_col, F.col(ts_col).cast("timestamp"))


def _counted(df: DataFrame, duration: str, slide: str | None, ts_col: str, sums: dict, keys=()) -> DataFrame:
    """Counts per window; with a slide from panes (a stream then needs a watermark and append mode)."""
    if slide:
        return sliding_sums(df, duration, slide, sums, keys, ts_col)
    return df.groupBy(F.window(ts_col, duration).alias("window"), *keys).agg(*[c.alias(k) for k, c in sums.items()])


def event_rate(df: DataFrame, duration: str = "5 minutes", slide: str | None = None,
               series: str = "event_type", ts_col: str = "ts") -> DataFrame:
    """Events per second per series over fixed (or sliding) ranges; the
    seconds are those of the window itself."""
    seconds = (F.unix_micros(F.col("window.end").cast("timestamp"))
               - F.unix_micros(F.col("window.start").cast("timestamp"))) / 1e6
    return (_counted(df, duration, slide, ts_col, {"events": F.count(F.lit(1))}, [series])
            .withColumn("rate_per_sec", F.col("events") / seconds))


def latency_quantiles(df: DataFrame, duration: str = "5 minutes", measure: str = "value",
                      series: str = "event_type", ts_col: str = "ts", approx: bool = False) -> DataFrame:
    """50th and 95th percentile of a measure per range and series. The exact form is a distributed selection
    (:mod:`opinari.operators.quantiles`), which holds no large series in one buffer; ``approx`` is a sketch of bounded
    size and rank error 1/10000. A stream needs ``approx``: exact quantiles aren't incremental."""
    if approx:
        q = F.percentile_approx(measure, [0.5, 0.95], 10000)
        found = df.groupBy(F.window(ts_col, duration).alias("window"), series).agg(q.alias("_q"))
    elif df.isStreaming:
        raise ValueError("a stream has approximate quantiles only: pass approx=True")
    else:
        rows = df.select(F.window(ts_col, duration).alias("window"), series, measure)
        found = exact_quantiles(rows, ["window", series], measure, [0.5, 0.95]).withColumnRenamed("q", "_q")
    return found.select("window", series, F.col("_q")[0].cast("double").alias("p50"), F.col("_q")[1].cast("double").alias("p95"))


def latest_state(df: DataFrame, key: str = "user_id", ts_col: str = "ts",
                 tie: str = "event_id", fields=("event_type", "value")) -> DataFrame:
    """Latest row per key (ties on time broken by ``tie``, a unique long).
    A partial aggregate either way: a key holding a third of all events is
    reduced on each task before the shuffle. On a table only (time, tie) is
    aggregated, packed into one decimal, and the winning rows are met again by
    their tie; a stream cannot join back and aggregates the row itself."""
    cols = [ts_col, *fields]
    if df.isStreaming:
        latest = F.max_by(F.struct(*cols), F.struct(ts_col, tie))
        return df.groupBy(key).agg(latest.alias("_l")).select(key, "_l.*")
    micros = F.coalesce(F.unix_micros(F.col(ts_col).cast("timestamp")), F.lit(-(1 << 62))).cast("decimal(19,0)")
    order = micros * F.lit(10 ** 18).cast("decimal(19,0)") + F.col(tie).cast("decimal(19,0)")
    last = df.groupBy(key).agg(F.max_by(tie, order).alias("_last")).select(F.col(key).alias("_key"), "_last")
    same = (F.col(tie) == F.col("_last")) & F.col(key).eqNullSafe(F.col("_key"))
    return df.join(last, same, "left_semi").select(key, *cols)


def error_ratio(df: DataFrame, duration: str = "5 minutes", ts_col: str = "ts",
                series: str = "event_type", error_value: str = "error", slide: str | None = None) -> DataFrame:
    """Share of error events in % per fixed (or sliding) range."""
    sums = {"events": F.count(F.lit(1)), "errors": F.count_if(F.col(series) == error_value)}
    return (_counted(df, duration, slide, ts_col, sums)
            .withColumn("error_pct", F.col("errors") * 100.0 / F.col("events")))


def alerts(ratios: DataFrame, rules=ALERT_RULES, metric_col: str = "error_pct") -> DataFrame:
    """E5: threshold alerts from a per-window metric table (``window``,
    ``metric_col``). A run of adjoining breaching windows is one alert (a
    window without events ends it): created at the run's first window start;
    resolved at its last window end when a later window exists, else active.

    The rules are configuration, so each window is paired with them by a
    ``stack`` generator (``#rules`` rows per window), not by a join. The
    look-back runs over the aggregated series: one row per window and rule,
    bounded by the time span, not by the event count."""
    rs = [r for r in rules if r.metric == metric_col]
    if not rs:
        raise ValueError(f"no alert rule for {metric_col}")
    stack = ", ".join(f"'{r.alert_type}', '{r.severity}', CAST({float(r.threshold)} AS DOUBLE)" for r in rs)
    rows = ratios.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"),
                         F.col(metric_col).alias("metric_value"),
                         F.expr(f"stack({len(rs)}, {stack}) AS (alert_type, severity, threshold)"))
    o = Window.partitionBy("alert_type").orderBy("start")
    flagged = (rows.withColumn("breach", F.col("metric_value") > F.col("threshold"))
               .withColumn("_prev", F.lag("breach").over(o) & (F.lag("end").over(o) >= F.col("start")))
               .withColumn("_open", (F.col("breach") & ~F.coalesce(F.col("_prev"), F.lit(False))).cast("int"))
               .withColumn("_run", F.sum("_open").over(o.rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("_data_end", F.max("end").over(Window.partitionBy("alert_type"))))
    runs = (flagged.filter("breach").groupBy("alert_type", "severity", "threshold", "_run", "_data_end")
            .agg(F.min("start").alias("created_at"), F.max("end").alias("_run_end"),
                 F.max("metric_value").alias("peak_value")))
    resolved = F.when(F.col("_run_end") < F.col("_data_end"), F.col("_run_end"))
    return runs.select(
        F.concat_ws("-", "alert_type", F.date_format("created_at", "yyyyMMddHHmm")).alias("alert_id"),
        "alert_type", "severity",
        F.concat(F.lit(metric_col + " above "), F.col("threshold").cast("string")).alias("message"),
        "created_at", resolved.alias("resolved_at"),
        F.when(resolved.isNull(), "active").otherwise("resolved").alias("status"), "peak_value")


def quality_over_time(df: DataFrame, duration: str = "1 hour", ts_col: str = "created_at", slide: str | None = None) -> DataFrame:
    """The A11 quality score per (fixed or sliding) window of comment time."""
    from opinari.operators.quality import quality_conditions, score_of_shares
    found = quality_conditions(df)
    sums = {"record_count": F.count(F.lit(1)), **{f"_q{i}": F.count_if(c) for i, (_, c) in enumerate(found)}}
    counted = _counted(df, duration, slide, ts_col, sums)
    score = score_of_shares([weight * F.try_divide(f"_q{i}", "record_count") for i, (weight, _) in enumerate(found)])
    return counted.select("window", "record_count", score.alias("quality_score"))


# ---------------------------------------------------------------------------
# Streams (E7–E9)
# ---------------------------------------------------------------------------

def incremental_scoring(spark: SparkSession, source_dir: str, schema, out_dir: str, checkpoint: str,
                        transform, trigger_once: bool = True):
    """Score comments as they land. ``transform`` is the batch function
    (clean → score); the checkpoint makes restarts exactly-once for the file
    sink. Returns the started query."""
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = (transform(stream).writeStream.format("parquet").option("path", out_dir)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if trigger_once else writer.trigger(processingTime="1 minute")
    return writer.start()


def dedup_stream(stream: DataFrame, keys: list[str], watermark_col: str | None = None,
                 delay: str = "10 minutes") -> DataFrame:
    """Duplicates across arrivals. Without a watermark the state keeps
    every key; with one, ``dropDuplicatesWithinWatermark`` bounds it."""
    if watermark_col is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(watermark_col, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts_with_watermark(stream: DataFrame, ts_col: str = "ts", delay: str = "10 minutes",
                                   duration: str = "1 hour", series: str = "event_type") -> DataFrame:
    """Late data — windows are emitted in append mode once the watermark
    passes their end; later events for a closed window are dropped."""
    return (stream.withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, duration).alias("window"), series)
            .agg(F.count(F.lit(1)).alias("events")))


def alert_stream(ratios: DataFrame, ratio_path: str, alert_path: str, checkpoint: str,
                 rules=ALERT_RULES, metric_col: str = "error_pct"):
    """E5 stream form: ``ratios`` is a stream of closed windows (E4 under a
    watermark, append mode). Each micro-batch is written to the ratio table
    under its batch number, so a repeated batch replaces itself, and the alerts
    are recomputed from all closed windows (one row per window) and written to
    ``alert_path``. Returns the started query."""
    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{ratio_path}/batch={number}")
        seen = spark.read.option("basePath", ratio_path).schema(batch.schema).parquet(f"{ratio_path}/batch=*")
        alerts(seen, rules, metric_col).write.mode("overwrite").parquet(alert_path)

    return (ratios.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


__all__ = ["AlertRule", "alert_stream", "alerts", "dedup_stream", "error_ratio", "event_rate", "incremental_scoring",
           "latency_quantiles", "latest_state", "quality_over_time", "windowed_counts_with_watermark",
           "with_event_time"]
