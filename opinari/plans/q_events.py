"""Event-time queries (E1–E6) in batch form over ``events`` (series =
``event_type``, measure = ``value``) and over comment time for E6. Window
starts are returned as ``yyyy-MM-dd HH:mm:ss`` strings."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinari.config import ALERT_RULES, FIXTURE_LEXICON, FIXTURE_SCORER
from opinari.plans import sqlfrag as S
from opinari.plans.q_quality import round_doubles, scored
from opinari.plans.registry import query
from opinari.sources.tables import read_table
from opinari.streaming import events as E

FMT = "yyyy-MM-dd HH:mm:ss"
DFMT = "'%Y-%m-%d %H:%M:%S'"


def _events(spark, sf):
    return read_table(spark, sf, "events")


def _start(col="window"):
    return F.date_format(F.col(f"{col}.start"), FMT).alias("window_start")


@query("event_rate", f"""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), {DFMT}) AS window_start,
  event_type, count(*) AS events, round(count(*) / 300.0, 6) AS rate_per_sec
FROM events GROUP BY 1, 2""")
def event_rate(spark, sf):
    r = E.event_rate(_events(spark, sf))
    return round_doubles(r.select(_start(), "event_type", "events", "rate_per_sec"))


@query("event_rate_sliding", f"""SELECT strftime(s, {DFMT}) AS window_start, event_type, count(*) AS events,
  round(count(*) / 3600.0, 6) AS rate_per_sec
FROM (SELECT event_type, time_bucket(INTERVAL 1 MINUTE, ts) - INTERVAL 1 MINUTE * unnest(generate_series(0, 59)) AS s FROM events)
GROUP BY 1, 2""")
def event_rate_sliding(spark, sf):
    """E1 over the last hour, every minute."""
    r = E.event_rate(_events(spark, sf), "1 hour", "1 minute")
    return round_doubles(r.select(_start(), "event_type", "events", "rate_per_sec"))


@query("latency_quantiles", f"""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), {DFMT}) AS window_start,
  event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95
FROM events GROUP BY 1, 2""")
def latency_quantiles(spark, sf):
    q = E.latency_quantiles(_events(spark, sf))
    return round_doubles(q.select(_start(), "event_type", "p50", "p95"))


@query("latest_state", f"""SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, event_type, value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_state(spark, sf):
    s = E.latest_state(_events(spark, sf))
    return s.select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
                    "event_type", "value")


@query("error_ratio", f"""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), {DFMT}) AS window_start,
  count(*) AS events, count_if(event_type = 'error') AS errors,
  round(count_if(event_type = 'error') * 100.0 / count(*), 6) AS error_pct
FROM events GROUP BY 1""")
def error_ratio(spark, sf):
    r = E.error_ratio(_events(spark, sf))
    return round_doubles(r.select(_start(), "events", "errors", "error_pct"))


def _alert_rules_sql() -> str:
    return ", ".join(f"('{r.alert_type}', '{r.severity}', {float(r.threshold)})" for r in ALERT_RULES
                     if r.metric == "error_pct")


@query("alerts", f"""WITH r AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start,
    time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end",
    count_if(event_type = 'error') * 100.0 / count(*) AS metric_value FROM events GROUP BY 1),
rules(alert_type, severity, threshold) AS (VALUES {_alert_rules_sql()}),
x AS (SELECT * FROM r, rules),
f AS (SELECT *, metric_value > threshold AS breach,
        lag(metric_value > threshold) OVER (PARTITION BY alert_type ORDER BY start)
          AND lag("end") OVER (PARTITION BY alert_type ORDER BY start) >= start AS prev,
        max("end") OVER (PARTITION BY alert_type) AS data_end FROM x),
g AS (SELECT *, sum(CASE WHEN breach AND NOT coalesce(prev, false) THEN 1 ELSE 0 END)
        OVER (PARTITION BY alert_type ORDER BY start ROWS UNBOUNDED PRECEDING) AS run FROM f),
runs AS (SELECT alert_type, severity, threshold, run, data_end, min(start) AS created_at,
           max("end") AS run_end, max(metric_value) AS peak_value
         FROM g WHERE breach GROUP BY alert_type, severity, threshold, run, data_end)
SELECT alert_type || '-' || strftime(created_at, '%Y%m%d%H%M') AS alert_id, alert_type, severity,
  'error_pct above ' || CAST(threshold AS VARCHAR) AS message,
  strftime(created_at, {DFMT}) AS created_at,
  strftime(CASE WHEN run_end < data_end THEN run_end END, {DFMT}) AS resolved_at,
  CASE WHEN run_end < data_end THEN 'resolved' ELSE 'active' END AS status,
  round(peak_value, 6) AS peak_value
FROM runs""")
def alerts(spark, sf):
    """E5 over hourly error shares (E4) with the configured rules."""
    ratios = E.error_ratio(_events(spark, sf), "1 hour")
    a = E.alerts(ratios, ALERT_RULES, "error_pct")
    return round_doubles(a.select(
        "alert_id", "alert_type", "severity", "message",
        F.date_format("created_at", FMT).alias("created_at"),
        F.date_format("resolved_at", FMT).alias("resolved_at"), "status", "peak_value"))


@query("quality_over_time", f"""WITH {S.COMMENTS_CTE},
{S.filtered_comments()},
scored AS (SELECT *, {S.lexicon_conf('cleaned_comment', FIXTURE_SCORER)} AS sentiment_confidence,
  {S.extract_aspects('cleaned_comment', FIXTURE_LEXICON)} AS detected_aspects FROM kept)
SELECT strftime(time_bucket(INTERVAL 1 HOUR, created_at), {DFMT}) AS window_start, count(*) AS record_count,
  round(greatest(0.0, least(100.0, 100.0
    - 20.0 * count_if(length(cleaned_comment) = 0) / count(*)
    - 10.0 * count_if(length(cleaned_comment) < 10) / count(*)
    - 15.0 * count_if(sentiment_confidence < 0.7) / count(*)
    + 5.0 * count_if(len(detected_aspects) > 0) / count(*))), 6) AS quality_score
FROM scored GROUP BY 1""")
def quality_over_time(spark, sf):
    """A11 per hour of comment time."""
    q = E.quality_over_time(scored(spark, sf), "1 hour", "created_at")
    return round_doubles(q.select(_start(), "record_count", "quality_score"))
