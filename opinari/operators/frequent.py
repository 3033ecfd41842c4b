"""The most frequent values without counting every value (A5 on large vocabularies).

1. One pass keeps a frequent-items summary per task (bounded, mergeable) and merges them to at most
   ``tracked`` candidates; nothing else is shuffled.
2. A second pass counts the candidates exactly; they are bounded, so they are broadcast.
3. Proof: with N values in all and a summary of M >= ``tracked`` / 0.75 counters, a value that it dropped occurs at most
   3.5 N / M times, and one that it holds but did not return at most as often as its least returned estimate. If the
   n-th exact count is above both, or the candidates make up all N values, no other value can
   be among the first ``n``. Otherwise the summary is widened, and beyond ``MAX_TRACKED`` every
   value is counted: the result is exact in any case.

Defined results: nulls are not counted; ties by the smaller value; fewer distinct values than ``n`` are all
returned; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinari.operators.base import written

TRACKED = 1 << 12
MAX_TRACKED = 1 << 16
WIDER = 16
#: Bound on the share of all values that a summary of M counters may miss, times M.
ERROR = 3.5


def _counted(values: DataFrame, col: str) -> DataFrame:
    return values.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def _missed(total: int, tracked: int, found: list) -> float:
    """How often a value may occur that isn't among those ``found``."""
    counters = 1
    while counters < tracked / 0.75:
        counters *= 2
    return max(ERROR * total / counters, found[-1]["count"] if len(found) >= tracked else 0)


def most_frequent(values: DataFrame, col: str, n: int, tracked: int = TRACKED, max_tracked: int = MAX_TRACKED) -> DataFrame:
    """(col, count) of the ``n`` most frequent strings in ``col``."""
    values = values.select(col).where(F.col(col).isNotNull())
    first = lambda counts: counts.orderBy(F.desc("count"), col).limit(n)
    while n <= tracked <= max_tracked:
        total, found = values.agg(F.count(F.lit(1)), F.expr(f"approx_top_k(`{col}`, {tracked}, {tracked})")).first()
        if not total:
            break
        asked = values.sparkSession.createDataFrame([(r["item"],) for r in found], values.schema)       # at most ``tracked`` rows
        counts = written(_counted(values.join(F.broadcast(asked), col, "left_semi"), col), "frequent")
        top = [r["count"] for r in first(counts).collect()]
        whole = counts.agg(F.sum("count")).first()[0] == total
        if whole or len(top) == n and top[-1] > _missed(total, tracked, found):
            return first(counts)
        tracked *= WIDER
    return first(_counted(values, col))
