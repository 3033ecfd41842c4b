"""Exact quantiles by distributed selection, against ``percentile``."""

import random
import struct

import pytest
from pyspark.sql import functions as F

from opinari.operators import quantiles as Q

ODD = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308,
       float("inf"), float("-inf"), 0.1, 1 / 3, 2.0 ** 52, 2.0 ** 53 - 1, 1e-300, 3.0, 2.9999999999999996]


def test_bits_keep_every_double_and_its_order(spark):
    r = random.Random(1)
    values = ODD + [struct.unpack("d", struct.pack("Q", r.getrandbits(64)))[0] for _ in range(3000)] + [r.uniform(-9, 9) for _ in range(500)]
    values = [v for v in values if v == v]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", Q._bits(F.col("v")).alias("b")).collect()
    for x in got:
        bits = struct.unpack("q", struct.pack("d", x["v"]))[0]
        assert x["b"] == (bits if bits >= 0 else -(bits & (1 << 63) - 1)), x["v"]


@pytest.mark.parametrize("few", [3, 50, 10_000])
def test_against_percentile(spark, few):
    r = random.Random(few)
    rows = [("a", r.choice([r.uniform(-5, 5), r.gauss(0, 1e200), 0.25, None])) for _ in range(1500)]
    rows += [("b", float(r.randrange(4))) for _ in range(1000)] + [("c", v) for v in ODD] + [("d", None)] * 9 + [(None, 2.5), (None, 7.0)]
    rows += [("e", 42.0)] * 400
    df = spark.createDataFrame(rows, "s string, v double")
    ps = [0.0, 0.25, 0.5, 0.95, 0.999, 1.0]
    want = df.groupBy("s").agg(F.percentile("v", F.array(*[F.lit(p) for p in ps])).alias("q"))
    got = Q.exact_quantiles(df, ["s"], "v", ps, few)
    clean = lambda d: {x["s"]: x["q"] and [0.0 if v == 0 else v for v in x["q"]] for x in d.collect()}
    assert clean(got) == clean(want)


def test_without_a_broadcast_and_empty(spark, monkeypatch):
    monkeypatch.setattr(Q, "MAX_BROADCAST", 0)
    df = spark.range(4000).select((F.col("id") % 3).alias("k"), F.sqrt("id").alias("v"))
    got = {x["k"]: x["q"] for x in Q.exact_quantiles(df, ["k"], "v", [0.5, 0.9], 20).collect()}
    want = {x["k"]: x["q"] for x in df.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.9))).alias("q")).collect()}
    assert got == want
    assert Q.exact_quantiles(df.limit(0), ["k"], "v", [0.5]).count() == 0
