"""Helpers shared by the operators: written intermediate tables, names that
don't clash, and a join that spreads hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinari.session import scratch_path, table_path


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: lineage is
    cut, a lost executor costs only its own tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: A key with more rows than total / HOT_SHARE is hot, so at most HOT_SHARE
#: keys are: the bound of the broadcast below.
HOT_SHARE = 10_000


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Left outer join on long ``keys`` of a table whose keys may be very
    uneven. ``right`` has one row per key and, in ``weight``, the number of
    left rows with it; ``total`` is the sum over all keys.

    Keys above ``total / HOT_SHARE`` rows are joined by a broadcast of at most
    HOT_SHARE rows; all others by a shuffle, where hot left rows take part
    under a key of their own row so that they spread and match nothing."""
    values = [c for c in right.columns if c not in keys and c != weight]
    limit = max(1, total // HOT_SHARE)
    hot = right.where(F.col(weight) > limit).select(
        *keys, F.struct(*values).alias("_hot"))
    cold = right.where(F.col(weight) <= limit).select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.struct(*values).alias("_cold"))
    out = left.join(F.broadcast(hot), keys, "left")
    spread = F.xxhash64(*[F.col(c) for c in left.columns])
    on = [F.when(F.col("_hot").isNull(), F.col(k)).otherwise(spread) == F.col(f"_{k}") for k in keys]
    out = out.join(cold, on, "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return out.select(*[F.col(c) for c in left.columns], *[found[v].alias(v) for v in values])
