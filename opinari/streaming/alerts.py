"""E5 on streams: alerts as keyed state with event-time timers.

The state of a rule is its open run and nothing else: three numbers however long
the history. A window that breaches the threshold opens a run, or prolongs it if
it begins where the run ends; any other later window ends it. A timer stands one
window length behind the run's end: when the watermark passes it without a
window there, the window had no events and the run is over. Every run gives one
``opened`` row and one ``resolved`` row.

The input is a stream of closed windows with a watermark (E4 in append mode):
windows of later batches are later than those before, and inside a batch they
are taken in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from opinari.config import ALERT_RULES

#: The state store that keyed state with timers needs; set on the session before the stream starts.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

OUT = ("alert_id string, alert_type string, severity string, message string, event string, "
       "created_at timestamp, resolved_at timestamp, peak_value double")


def _stamp(micros: int):
    return pd.Timestamp(micros, unit="us")


class AlertRuns(StatefulProcessor):
    """The open run of each alert type."""

    def __init__(self, rules, metric: str):
        self.rules, self.metric = {r.alert_type: (r.severity, float(r.threshold)) for r in rules}, metric

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "created long, ended long, length long, peak double")

    def _row(self, key, event: str, created: int, resolved: int | None, peak: float) -> tuple:
        severity, threshold = self.rules[key]
        at = _stamp(created)
        return (f"{key}-{at.strftime('%Y%m%d%H%M')}", key, severity, f"{self.metric} above {threshold}", event, at,
                None if resolved is None else _stamp(resolved), peak)

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        names = [c.split()[0] for c in OUT.split(", ")]
        frame = pd.DataFrame(rows, columns=names)
        for c in ("created_at", "resolved_at"):
            frame[c] = pd.to_datetime(frame[c])
        return frame

    def _timer(self, run) -> int:
        return (run[1] + run[2]) // 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        run = self.run.get() if self.run.exists() else None
        before = run
        out = []
        threshold = self.rules[key[0]][1]
        for start, end, value in pd.concat(list(rows))[["start", "end", "value"]].sort_values("start").itertuples(index=False):
            start, end, breach = int(start), int(end), value is not None and value > threshold
            if run is not None and start >= run[1] and not (breach and start == run[1]):
                out.append(self._row(key[0], "resolved", run[0], run[1], run[3]))
                run = None
            if breach and run is None:
                run = (start, end, end - start, float(value))
                out.append(self._row(key[0], "opened", start, None, float(value)))
            elif breach:
                run = (run[0], max(run[1], end), run[2], max(run[3], float(value)))
        if before is not None and (run is None or self._timer(run) != self._timer(before)):
            self.handle.deleteTimer(self._timer(before))
        if run is None:
            self.run.clear()
        else:
            self.run.update(run)
            self.handle.registerTimer(self._timer(run))
        if out:
            yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        run = self.run.get() if self.run.exists() else None
        if run is not None and self._timer(run) <= expiredTimerInfo.getExpiryTimeInMs():
            self.run.clear()
            yield self._frame([self._row(key[0], "resolved", run[0], run[1], run[3])])

    def close(self) -> None:
        pass


def alert_events(ratios: DataFrame, rules=ALERT_RULES, metric_col: str = "error_pct") -> DataFrame:
    """``opened`` and ``resolved`` rows of a stream of closed windows (``window``, ``metric_col``; the window
    carries the watermark). Work per batch is one row per window and rule, the state one run per rule."""
    rs = [r for r in rules if r.metric == metric_col]
    if not rs:
        raise ValueError(f"no alert rule for {metric_col}")
    types = ", ".join(f"'{r.alert_type}'" for r in rs)
    rows = ratios.select(F.window_time("window").alias("at"), F.unix_micros(F.col("window.start").cast("timestamp")).alias("start"),
                         F.unix_micros(F.col("window.end").cast("timestamp")).alias("end"),
                         F.col(metric_col).cast("double").alias("value"), F.expr(f"explode(array({types}))").alias("alert_type"))
    return rows.groupBy("alert_type").transformWithStateInPandas(
        statefulProcessor=AlertRuns(rs, metric_col), outputStructType=OUT, outputMode="append", timeMode="EventTime")


def alert_table(events: DataFrame) -> DataFrame:
    """The alerts of a table of such events, as :func:`opinari.streaming.events.alerts` gives them; the peak of
    one that is still active is the one it was opened with."""
    last = events.groupBy("alert_id", "alert_type", "severity", "message", "created_at").agg(
        F.max("resolved_at").alias("resolved_at"), F.max("peak_value").alias("peak_value"))
    return last.select("alert_id", "alert_type", "severity", "message", "created_at", "resolved_at",
                       F.when(F.col("resolved_at").isNull(), "active").otherwise("resolved").alias("status"), "peak_value")


def write_alerts(ratios: DataFrame, path: str, checkpoint: str, rules=ALERT_RULES, metric_col: str = "error_pct"):
    """The stream job: alert events appended to ``path`` exactly once (file sink and checkpoint). Returns the started query."""
    ratios.sparkSession.conf.set(*STATE_STORE)
    return (alert_events(ratios, rules, metric_col).writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
