"""E5 as keyed state: through a stream equal to the batch form on closed windows."""

import os
import tempfile

from pyspark.sql import functions as F

from opinari.config import AlertRule
from opinari.streaming import alerts as S
from opinari.streaming import events as E

RULES = (AlertRule("high", "error_pct", 30.0, "warning"), AlertRule("worst", "error_pct", 60.0, "critical"))


def hours(spark, pattern):
    """Ten events an hour; ``pattern[h]`` of them are errors (None: no events)."""
    rows = [(f"2024-01-{1 + h // 24:02d} {h % 24:02d}:{m:02d}:30", "error" if m < n else "view")
            for h, n in pattern.items() if n is not None for m in range(10)]
    return spark.createDataFrame(rows, "s string, event_type string").select(F.to_timestamp("s").alias("ts"), "event_type")


def test_stream_equals_batch_with_gap_and_restart(spark):
    base = tempfile.mkdtemp(prefix="opinari-e5-")
    src, out, ckpt = (os.path.join(base, x) for x in ("src", "out", "ckpt"))
    first = {0: 1, 1: 5, 2: 7, 3: 7, 4: 0, 5: 4, 6: 4, 7: None, 8: None, 9: None, 10: 4, 11: 8, 12: 8}
    then = {13: 9, 14: 4, 15: 1, 16: 1, 17: 5, 18: None, 19: None, 20: 5, 21: 5, 22: 0}
    last = {23: 0, 24: 7, 25: 7, 26: 2, 27: 2, 28: 2}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    counts = []
    for part in (first, then, last):
        hours(spark, part).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("ts timestamp, event_type string").parquet(src).withWatermark("ts", "1 minute")
        query = S.write_alerts(E.error_ratio(stream, "1 hour"), out, ckpt, RULES)          # a new query each time: a restart
        query.awaitTermination()
        assert query.exception() is None
        counts.append(spark.read.parquet(out).count())
    spark.conf.set("spark.sql.shuffle.partitions", before)
    events = spark.read.parquet(out)
    assert counts[0] < counts[1] < counts[2]
    assert events.groupBy("alert_id", "event").count().where("count > 1").count() == 0
    seen = hours(spark, {**first, **then, **last})
    border = seen.agg(F.max("ts") - F.expr("INTERVAL 1 MINUTE")).first()[0]
    closed = E.error_ratio(seen, "1 hour").where(F.col("window.end") <= F.lit(border))
    want = E.alerts(closed, RULES)
    columns = sorted(want.columns)
    got = S.alert_table(events).select(*columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.select(*columns).collect()), key=repr)
    assert want.where("status = 'resolved'").count() == want.count() > 5
