"""Loads that can be repeated (S7, S9–S11): staged write, manifest row, committed reads.

A table of loads is a folder::

    <table>/data/load=<id>/attempt=<number>/...     what an attempt wrote
    <table>/commits/load=<id>/...                   one manifest row per committed attempt

A load writes its rows under a fresh attempt and then, as its commit, one manifest
row. Readers take the attempts that the manifest names and nothing else, so a load
that breaks off before its commit leaves no rows, whatever files it left. A load
whose id is committed is not written again: a scheduler may repeat it any
number of times. If two repeats of one load run at once and both commit, readers
take the first one by time and attempt; all readers choose the same.

The manifest has one row per load, so the reader's join with it is a broadcast
that is checked, and prunes the folders of other attempts when it is planned.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from opinari.operators.base import small

COMMIT = "load string, attempt string, row_count long, schema string, partitions string, committed_at timestamp"


def _at(table: str, part: str) -> str:
    return f"{table.rstrip('/')}/{part}"


def commits(spark: SparkSession, table: str) -> DataFrame:
    """The manifest: one row per committed load."""
    path = _at(table, "commits")
    try:
        found = spark.read.schema(COMMIT).option("basePath", path).parquet(path)
    except AnalysisException:                                # nothing was ever committed
        return spark.createDataFrame([], COMMIT)
    first = F.min(F.struct("committed_at", "attempt", "row_count", "schema", "partitions")).alias("c")
    return found.groupBy("load").agg(first).select("load", "c.attempt", "c.row_count", "c.schema", "c.partitions", "c.committed_at")


def is_committed(spark: SparkSession, table: str, load: str) -> bool:
    return bool(commits(spark, table).where(F.col("load") == load).limit(1).count())


def _commit(spark: SparkSession, table: str, load: str, attempt: str, schema: T.StructType, partition_by: tuple[str, ...]) -> None:
    rows = spark.read.schema(schema).option("basePath", _staged(table, load, attempt)).parquet(_staged(table, load, attempt)) \
        .agg(F.count(F.lit(1)).alias("row_count"))
    row = rows.select(F.lit(attempt).alias("attempt"), "row_count", F.lit(schema.json()).alias("schema"),
                      F.lit(",".join(partition_by)).alias("partitions"), F.current_timestamp().alias("committed_at"))
    row.coalesce(1).write.mode("append").parquet(f"{_at(table, 'commits')}/load={load}")


def _staged(table: str, load: str, attempt: str) -> str:
    return f"{_at(table, 'data')}/load={load}/attempt={attempt}"


def load(df: DataFrame, table: str, load_id: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Write ``df`` to ``table`` as the load ``load_id`` unless that is committed; whether it was written now.
    ``load_id`` takes letters, digits, ``_`` and ``-`` (it names a folder)."""
    if not load_id or not all(c.isalnum() or c in "_-" for c in load_id):
        raise ValueError("a load id has letters, digits, '_' and '-'")
    taken = {"load", "attempt"} & {c.lower() for c in df.columns}
    if taken:
        raise ValueError(f"names of the protocol's own columns: {sorted(taken)}")
    spark = df.sparkSession
    if is_committed(spark, table, load_id):
        return False
    attempt = uuid.uuid4().hex
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(_staged(table, load_id, attempt))
    _commit(spark, table, load_id, attempt, df.schema, partition_by)
    return True


def read(spark: SparkSession, table: str, load_column: str | None = None) -> DataFrame:
    """The rows of all committed loads, with the load's id in ``load_column`` if it is named. Loads may add
    columns; rows of loads without one have null there."""
    manifest = commits(spark, table)
    schemas = [T.StructType.fromJson(json.loads(r["schema"])) for r in manifest.select("schema").distinct().collect()]
    if not schemas:
        raise FileNotFoundError(f"no committed load in {table}")
    fields: dict[str, T.StructField] = {}
    for s in schemas:                                        # few: one per change of the table's columns
        for f in s.fields:
            known = fields.setdefault(f.name, T.StructField(f.name, f.dataType, True))
            if known.dataType != f.dataType:
                raise ValueError(f"column {f.name} is {known.dataType.simpleString()} and {f.dataType.simpleString()}")
    full = T.StructType([*fields.values(), T.StructField("load", T.StringType()), T.StructField("attempt", T.StringType())])
    rows = spark.read.schema(full).option("basePath", _at(table, "data")).parquet(_at(table, "data"))
    kept = rows.join(small(manifest.select("load", "attempt")), ["load", "attempt"], "left_semi")
    own = [F.col("load").alias(load_column)] if load_column else []
    return kept.select(*fields, *own)


def once(spark: SparkSession, df: DataFrame, table: str) -> DataFrame:
    """The table as it was first written whole; written now if it never was."""
    load(df, table, "once")
    return read(spark, table)
