"""Duplicate removal, per-group caps, top-k and set operations.

Skew: duplicate removal is a ``groupBy`` on a hash of the key with ``min`` of
the order, with a map-side partial step, so a text repeated in a third of all
rows collapses to one row per partition before the shuffle. A window
``row_number`` over the same key would move all those rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinari.operators.base import key_hash


def dedup_first(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """Keep the first row (lowest ``order_col``, unique inside a group) of each
    key group. Null keys form their own group, as in pandas
    ``drop_duplicates``. The group's key is a 128-bit hash, so only longs are
    aggregated and compared; the rows are met again under (hash, order), which
    is spread evenly however large a group is."""
    h1, h2 = key_hash(keys)
    keyed = df.withColumn("_h1", h1).withColumn("_h2", h2)
    first = keyed.groupBy("_h1", "_h2").agg(F.min(order_col).alias("_first")) \
        .select(F.col("_h1").alias("_g1"), F.col("_h2").alias("_g2"), "_first")
    same = (F.col("_h1") == F.col("_g1")) & (F.col("_h2") == F.col("_g2")) & F.col(order_col).eqNullSafe(F.col("_first"))
    return keyed.join(first, same, "left_semi").drop("_h1", "_h2")


def cap_per_group(df: DataFrame, group_col: str, order_col: str, n: int) -> DataFrame:
    """First ``n`` rows per group. ``row_number() <= n`` lets Catalyst
    insert a ``WindowGroupLimit`` below the shuffle, so each map task keeps at
    most ``n`` rows per group and a hot group costs ``n x #partitions`` rows in
    the shuffle, not its size."""
    w = Window.partitionBy(group_col).orderBy(order_col)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_n(df: DataFrame, order_col: str, n: int) -> DataFrame:
    """The ``n`` first rows in ``order_col`` order (TakeOrderedAndProject:
    per-partition top-k, then a merge of ``n x #partitions`` rows)."""
    return df.orderBy(order_col).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; missing columns are filled with null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def removed_rows(before: DataFrame, after: DataFrame, id_col: str,
                 reason: F.Column | None = None) -> DataFrame:
    """Rows of ``before`` missing from ``after`` (anti join on the id),
    with an optional reason column computed on ``before``."""
    out = before.join(after.select(id_col), id_col, "left_anti")
    if reason is not None:
        out = out.withColumn("reason", reason)
    return out
