"""Connected components of a distributed edge list by alternating large-star
and small-star steps: only edges are kept, every step is a shuffle on narrow
rows, and hubs are joined through :func:`join_hot`."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinari.llm.common import join_hot, written


def _stats(e: DataFrame) -> tuple:
    r = e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_003), F.lit(0))).first()
    return tuple(r)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every id of ``edges (a, b)``: the smallest id that can be
    reached. Loops, repeated and reversed edges are harmless; null ends are
    ignored; an empty table gives no rows."""
    e = written(edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .distinct(), "edges")
    before = _stats(e)
    for _ in range(max_rounds if before[0] else 0):
        # Large star: what hangs on a moves to a's smallest neighbour.
        parent = e.groupBy(F.col("b").alias("a")).agg(F.min("a").alias("p"))
        degree = e.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        e = written(join_hot(e, degree.join(parent, "a", "left"), ["a"], "n", before[0])
                    .select(F.coalesce("p", "a").alias("a"), "b").distinct(), "edges")
        # Small star: b and its other smaller neighbours move to the smallest one.
        low = e.groupBy("b").agg(F.min("a").alias("p"), F.count(F.lit(1)).alias("n"))
        e = join_hot(e, low, ["b"], "n", before[0]) \
            .select(F.col("p").alias("a"), F.when(F.col("a") == F.col("p"), F.col("b")).otherwise(F.col("a")).alias("b"))
        e = written(e.distinct(), "edges")
        after = _stats(e)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError("components did not converge")
    ids = e.select(F.col("b").alias("id"), F.col("a").alias("component"))
    roots = e.select(F.col("a").alias("id"), F.col("a").alias("component")).distinct()
    return ids.union(roots)
