"""Driver tables and the canonical views the operators run on.

``comments`` turns ``documents`` into review comments with the noise the
cleaning rules need (URLs, tags, e-mail, nulls, bad ratings); ``games`` is the
game dimension. Both are plain projections of the scan, so filters and column
pruning still reach the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinari.operators.base import spread
from opinari.session import scratch_path, table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Text tables and the key used to spread a scan that arrives in few splits.
TEXT_KEYS = {"documents": "doc_id", "conversations": "conv_id", "pages": "page_id",
             "benchmark": "item_id"}


#: Session setting: hash-partition text tables into so many partitions after
#: the scan (0, the default: leave the scan's own). For one small file on many
#: local cores; a cluster reading many files needs none.
SPREAD = "spark.opinari.spread"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    n = int(spark.conf.get(SPREAD, "0"))
    return spread(df, TEXT_KEYS[name], n) if n and name in TEXT_KEYS else df


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comment view over ``documents`` (FIXTURES.md §2)."""
    d = read_table(spark, sf_dir, "documents")
    cid = F.col("doc_id")
    username = F.when(cid % 11 == 0, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(" user"), (cid % 50).cast("string"), F.lit(" ")))
    rating = (F.when(cid % 7 == 0, F.lit("N/A"))
              .when(cid % 7 == 1, F.lit(None).cast("string"))
              .when(cid % 7 == 2, F.lit("7d"))
              .when(cid % 7 == 3, F.lit("nan"))
              .otherwise((cid % 10 + 1).cast("string")))
    value = (F.when(cid % 97 == 0, F.lit(None).cast("string"))
             .when(cid % 5 == 0, F.concat(F.lit("see [b]note[/b] http://ex.org/"), cid.cast("string"),
                                          F.lit("?q=1 "), F.col("text")))
             .when(cid % 5 == 1, F.concat(F.lit("[IMG]pic"), cid.cast("string"),
                                          F.lit("[/IMG] www.ex.org "), F.col("text")))
             .when(cid % 5 == 2, F.concat(F.lit("me@ex.org says: "), F.col("text")))
             .otherwise(F.col("text")))
    created = F.timestamp_add("MINUTE", cid, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return d.select(cid.alias("comment_id"), F.col("source").alias("game_id"),
                    username.alias("username"), rating.alias("rating"), value.alias("value"),
                    F.col("lang"), created.alias("created_at"))


def with_global_rank(df: DataFrame, order_col: str, rank_col: str = "rank",
                     partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order_col`` order, without moving the
    table into one task: range-partition, write the rows with their partition
    number once to the shared folder, count rows per partition (one small row
    each), turn the counts into offsets and add the row number inside each
    partition. Counts and rows are read from the same written table: two range
    exchanges would each sample borders of their own. ``order_col`` must be
    unique."""
    spark = df.sparkSession
    n = partitions or spark.sparkContext.defaultParallelism
    part, offset, count = (_fresh(df, c) for c in ("_part", "_offset", "_count"))
    path = scratch_path(spark, "ranked")
    df.repartitionByRange(n, order_col).withColumn(part, F.spark_partition_id()).write.parquet(path)
    parted = spark.read.parquet(path)
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = parted.groupBy(part).agg(F.count(F.lit(1)).alias(count)).select(
        part, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(offset))
    # One row per partition: at most ``n`` rows, a bounded broadcast.
    w = Window.partitionBy(part).orderBy(order_col)
    return (parted.join(F.broadcast(offsets), part)
            .withColumn(rank_col, F.col(offset) + F.row_number().over(w)).drop(part, offset))


def _fresh(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Game dimension: one row per source, name ``Game <source>``, rank in
    source order."""
    g = (read_table(spark, sf_dir, "documents").select(F.col("source").alias("game_id"))
         .distinct())
    g = g.withColumn("name", F.concat(F.lit("Game "), F.col("game_id")))
    return with_global_rank(g, "game_id").select("game_id", "name", F.col("rank").cast("long"))


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 + J6: labelled text — documents joined with labels, label = quality."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars", "lang", "source")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"),
                                                     "toxic")
    return d.join(lab, "doc_id", "inner")
