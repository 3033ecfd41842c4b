"""Exact quantiles at any size, by distributed selection.

A quantile of a series is fixed by one or two ranks. Doubles are mapped to longs in
the same order, and the range that holds a rank, a prefix of their bits, is narrowed
in rounds: each counts the values per next ``BITS`` bits (one aggregate with a
map-side part, so a round shuffles at most ``2**BITS`` rows per series, rank
and task) and keeps the part with the rank. After ``64 / BITS`` rounds at most the
part is one value. Parts of at most ``FEW`` values are sorted as one array, and series
of no more go through ``percentile`` at once.

No task holds more than ``FEW`` values of a series, however many are distinct.

Defined results: as ``percentile`` has it, the quantile ``p`` of ``n`` values stands at ``p * (n - 1)``, between two
neighbours by linear interpolation; nulls don't count; a series without values
gives null; -0.0 counts as 0.0; NaN sorts above all other values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.session import scratch_path

BITS = 10            # a round cuts each range into 1,024 parts
FEW = 10_000         # values of a range that are sorted as one array
#: Ranges (key and two longs) that may be broadcast.
MAX_BROADCAST = 200_000


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def _bits(c: Column) -> Column:
    """A double as a long of the same order: the sign bit and the other bits as a number, by arithmetic on exponent and
    fraction, which is exact (a double has 53 bits)."""
    v = F.when(c == 0, F.lit(0.0)).otherwise(c)
    size = F.abs(v)
    e = F.floor(F.log2(size))
    # log2 may be off by one at a border of two powers.
    e = e + F.when(F.pow(F.lit(2.0), e + 1) <= size, 1).when(F.pow(F.lit(2.0), e) > size, -1).otherwise(0)
    e = F.greatest(e, F.lit(-1022))
    fraction = (size / F.pow(F.lit(2.0), e - 52)).cast("long")
    number = (e + 1023).cast("long") * F.lit(1 << 52) + fraction - F.lit(1 << 52)
    number = F.when(size == float("inf"), F.lit(0x7FF << 52)).when(size == 0, F.lit(0)).otherwise(number)
    return F.when(F.isnan(v), F.lit((0x7FF << 52) + 1)).when(v < 0, -number).otherwise(number)


def exact_quantiles(df: DataFrame, keys: list[str], measure: str, probabilities: list[float], few: int = FEW) -> DataFrame:
    """``keys`` and, in ``q``, the quantiles of ``measure`` in each group: an array of doubles in the order of ``probabilities``."""
    rows = df.select(*keys, (F.col(measure).cast("double") + F.lit(0.0)).alias("_v"))
    total = _written(rows.groupBy(*keys).agg(F.count("_v").alias("_n")), "totals")
    small = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probabilities])).alias("q")
    large = total.where(F.col("_n") > few)
    if not large.limit(1).count():
        return rows.groupBy(*keys).agg(small)
    names = _named(_sized(large.select(*keys)), keys)
    on = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(names[f"_k{i}"]) for i, k in enumerate(keys)], F.lit(True))
    return rows.join(names, on, "left_anti").groupBy(*keys).agg(small).union(_selected(rows, large, keys, probabilities, few))


def _named(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in df.columns if c not in keys])


def _selected(rows: DataFrame, total: DataFrame, keys: list[str], probabilities: list[float], few: int) -> DataFrame:
    """Quantiles of the series of ``total (keys, _n)`` by narrowing ranges round the wanted ranks."""
    own = [f"_k{i}" for i in range(len(keys))]
    # The ranks each quantile needs, counted from 0: the value below and the value above.
    at = F.explode(F.array(*[F.lit(float(p)) * (F.col("_n") - 1) for p in probabilities])).alias("_at")
    wanted = total.select(*keys, at).select(*keys, F.explode(F.array(F.floor("_at"), F.ceil("_at"))).alias("_rank")).distinct()
    # A range: the upper bits of its values (all of them at first) and the rank inside it.
    open_ = _written(_named(wanted, keys).select(*own, "_rank", F.col("_rank").alias("_in"), F.lit(0).cast("long").alias("_prefix")), "ranges")
    numbered = rows.where("_v is not null").withColumn("_b", _bits(F.col("_v")))
    same = lambda a, b, names: reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[o]) for k, o in zip(names, own)], F.lit(True))
    shift, done = 64, []

    def met(ranges: DataFrame) -> DataFrame:
        near = _sized(ranges)
        inside = F.lit(True) if shift == 64 else F.shiftright(numbered["_b"], shift) == near["_prefix"]
        return numbered.join(near, same(numbered, near, keys) & inside)

    while open_.limit(1).count():
        lower = max(0, shift - BITS)
        counts = met(open_).groupBy(*own, "_rank", "_in", F.shiftright("_b", lower).alias("_part")).agg(F.count(F.lit(1)).alias("_m"))
        # At most 2**BITS parts of a range, in order, up to the one with the rank.
        parts = counts.groupBy(*own, "_rank", "_in").agg(F.array_sort(F.collect_list(F.struct("_part", "_m"))).alias("_ps"))
        null = F.lit(None).cast("long")
        walk = F.aggregate("_ps", F.struct(F.lit(0).cast("long").alias("before"), null.alias("part"), null.alias("m")), lambda a, p: F.when(
            a["part"].isNotNull(), a).otherwise(F.when(
                a["before"] + p["_m"] > F.col("_in"), F.struct(a["before"].alias("before"), p["_part"].alias("part"), p["_m"].alias("m")))
            .otherwise(F.struct((a["before"] + p["_m"]).alias("before"), a["part"].alias("part"), a["m"].alias("m")))))
        found = parts.withColumn("_f", walk).select(*own, "_rank", (F.col("_in") - F.col("_f.before")).alias("_in"),
                                                    F.col("_f.part").alias("_prefix"), F.col("_f.m").alias("_m"))
        found, shift = _written(found, "ranges"), lower
        ready = (F.col("_m") <= few) | F.lit(shift == 0)
        got = met(found.where(ready)).groupBy(*own, "_rank", "_in")
        # Few values are sorted; a range of one value needs no order.
        got = got.agg(F.min("_v").alias("_x")) if shift == 0 else \
            got.agg(F.collect_list("_v").alias("_all")).withColumn("_x", F.get(F.array_sort("_all"), F.col("_in").cast("int")))
        done.append(_written(got.select(*own, "_rank", "_x"), "found"))
        open_ = found.where(~ready).drop("_m")
    values = reduce(DataFrame.union, done).groupBy(*own).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))

    def quantile(p: float) -> Column:
        place = F.lit(float(p)) * (F.col("_n") - 1)
        below, above = (F.try_element_at("_at", f(place).cast("long")) for f in (F.floor, F.ceil))
        return F.when(F.floor(place) == F.ceil(place), below).otherwise(
            (F.ceil(place) - place) * below + (place - F.floor(place)) * above)

    return total.join(values, same(total, values, keys)).select(*keys, F.array(*[quantile(p) for p in probabilities]).alias("q"))
