"""Sliding windows from panes (E1, E4, E6 with a slide).

A sliding window copies every event ``duration / slide`` times before it is aggregated. Here events are
aggregated once, by pane: tumbling ranges as long as the greatest common divisor of duration and slide,
which divide every window evenly. The panes' partial counts, one row per pane and key, are then added up
for the windows they lie in, so the copies are made of panes and not of events.

Panes start at the epoch, as windows without an offset do. On a stream this is a window over a window: it needs
a watermark and append mode. Defined results: rows without a time are in no window; a null key is a key.
"""

from __future__ import annotations

import re
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
          "day": 86400 * 10**6, "week": 7 * 86400 * 10**6}


def micros(duration: str) -> int:
    """Microseconds of a fixed duration such as ``5 minutes`` or ``1 hour 30 minutes``."""
    found = re.findall(r"(\d+)\s*([a-z]+?)s?(?=\s|\d|$)", duration.lower())
    if not found or re.sub(r"\d+\s*[a-z]+|\s", "", duration.lower()) or any(unit not in MICROS for _, unit in found):
        raise ValueError(f"not a fixed duration: {duration!r}")
    return sum(int(n) * MICROS[unit] for n, unit in found)


def pane_length(duration: str, slide: str) -> str:
    if micros(slide) <= 0 or micros(slide) > micros(duration):
        raise ValueError("a slide is above 0 and at most the duration")
    return f"{gcd(micros(duration), micros(slide))} microseconds"


def sliding_sums(df: DataFrame, duration: str, slide: str, sums: dict[str, Column], keys=(), ts_col: str = "ts") -> DataFrame:
    """(window, keys, names of ``sums``): aggregates that add up (counts, sums) over sliding windows."""
    panes = df.groupBy(F.window(ts_col, pane_length(duration, slide)).alias("_pane"), *keys) \
        .agg(*[agg.alias(name) for name, agg in sums.items()])
    return panes.groupBy(F.window("_pane", duration, slide).alias("window"), *keys) \
        .agg(*[F.sum(name).alias(name) for name in sums])
