"""A score table that isn't shuffled.

The table is bucketed by ``text_key``: Spark knows that equal keys lie in one bucket,
so a join with it reads each bucket where it is needed and only the other side,
the increment, is exchanged. Its cost follows the increment, not the history. New
scores are appended bucket by bucket (one file per bucket and append), so the
property stays.

The files are an ordinary Parquet folder; the session's catalog only holds the
definition, which :func:`open_scores` makes again in a new session.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinari.operators.sentiment import SCORE_TABLE, incremental_scores

BUCKETS = 64


def open_scores(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """The name of the score table over ``path``, made if it isn't there. All sessions must give the same
    number of buckets, as it lies in the files' names."""
    name = f"scores_{hashlib.md5(f'{path}:{buckets}'.encode()).hexdigest()[:12]}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SCORE_TABLE.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"CLUSTERED BY (text_key) INTO {buckets} BUCKETS LOCATION '{path}'")
    return name


def append_scores(spark: SparkSession, table: str, df: DataFrame, score_fn: Callable[[DataFrame, str], DataFrame],
                  text_col: str = "cleaned_comment", buckets: int = BUCKETS) -> None:
    """Score the texts of ``df`` that have no score yet and append them."""
    new = incremental_scores(df, spark.table(table), score_fn, text_col)
    new.repartition(buckets, "text_key").write.insertInto(table)
    spark.catalog.refreshTable(table)
