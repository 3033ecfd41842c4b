"""Plan-shape helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.session import scratch_path


def with_columns_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns that later filters must not re-evaluate.

    Catalyst pushes a filter below the projection that defines the columns it
    tests and substitutes their defining expressions. For cheap columns that is
    right; for an expensive one (a chain of regular expressions over a whole
    comment) it repeats the work once per reference — 25 times for a lexicon
    test over cleaned text — and the inflated filter drops out of codegen.
    Producing the columns from a one-row ``inline`` generator keeps them as
    attributes: filters above stop at the generator, and the plan stays one
    whole-stage-codegen span.
    """
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(k) for k, e in cols.items()]))))


def spread(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Hash-partition a scan that arrives in fewer splits than there are task
    slots, so per-row text work runs in parallel. The caller decides: it is a
    shuffle of the whole rows. Hash partitioning on a key (not round robin)
    keeps partition contents the same when a lost task is recomputed."""
    return df.repartition(partitions, key)


def key_hash(cols) -> tuple[Column, Column]:
    """128-bit key of some columns as two longs; null is a value of its own."""
    cols = [F.col(c) if isinstance(c, str) else c for c in cols]
    parts = cols + [c.isNull() for c in cols]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


#: A key with more rows than total / HOT_SHARE is hot, so at most HOT_SHARE keys are.
HOT_SHARE = 10_000


def join_hot(left: DataFrame, right: DataFrame, key: str, weight: str, total: int, how: str = "left") -> DataFrame:
    """Equi-join (``left`` or ``inner``) on a key that may hold a large share of the
    rows. ``right`` has one row per key and, in ``weight``, the number of left
    rows with it; ``total`` is the sum over all keys. Keys above
    ``total / HOT_SHARE`` rows are joined by a broadcast of at most HOT_SHARE
    rows; the others by a shuffle, in which hot left rows carry a key of their
    own row, spread evenly and match nothing."""
    values = [c for c in right.columns if c not in (key, weight)]
    hot = F.col(weight) > max(1, total // HOT_SHARE)
    near = right.where(hot).select(key, F.struct(*values).alias("_hot"))
    far = right.where(~hot).select(F.xxhash64(key).alias("_k"), F.col(key).alias("_key"), F.struct(*values).alias("_cold"))
    out = left.join(F.broadcast(near), key, "left")
    own = F.when(F.col("_hot").isNull(), F.xxhash64(key)).otherwise(F.xxhash64(*[F.col(c) for c in left.columns]))
    out = out.join(far, (own == F.col("_k")) & (F.col(key) == F.col("_key")), "left")
    found = F.coalesce("_hot", "_cold")
    if how == "inner":
        out = out.where(found.isNotNull())
    return out.select(*left.columns, *[found[v].alias(v) for v in values])


def small(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, for tables that several branches of a plan need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def portions(weight: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(first row, rows) of portions of an Arrow batch whose ``weight`` (null counts as 0) sums to about ``limit``, so that
    what Python makes of a portion stays small beside the batch."""
    ends = np.cumsum(np.asarray(pc.fill_null(weight, 0).cast(pa.int64())))
    i, done = 0, 0
    while i < len(ends):
        j = max(int(np.searchsorted(ends, done + limit, side="right")), i + 1)
        yield i, j - i
        i, done = j, int(ends[j - 1])


class NumberTable:
    """Places of 64-bit numbers in ``numbers`` (distinct), as a hash table in numpy: a lookup costs a few array accesses,
    not a binary search."""

    def __init__(self, numbers: np.ndarray):
        self.numbers = np.append(numbers.astype(np.int64), np.int64(0))
        self.bits = max(4, int(4 * len(numbers)).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.probes, left = 0, np.arange(len(numbers), dtype=np.int32)
        while len(left):
            at = self._at(self.numbers[left], self.probes)
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]                  # of several in one slot the last stays
            left = left[self.slot[at] != left]
            self.probes += 1

    def _at(self, numbers: np.ndarray, probe: int) -> np.ndarray:
        mixed = numbers.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed >> np.uint64(64 - self.bits)).view(np.int64) + probe) & ((1 << self.bits) - 1)

    def places(self, numbers: np.ndarray) -> np.ndarray:
        """The place of each of ``numbers``, or -1."""
        out = np.full(len(numbers), -1, np.int32)
        asked, index = numbers, None
        for probe in range(self.probes):
            found = self.slot[self._at(asked, probe)]
            hit = (found >= 0) & (self.numbers[found] == asked)
            if index is None:
                out[hit] = found[hit]
                index = np.flatnonzero((found >= 0) & ~hit)
            else:
                out[index[hit]] = found[hit]
                index = index[(found >= 0) & ~hit]
            if not len(index):
                break
            asked = numbers[index]
        return out
