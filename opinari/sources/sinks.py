"""Sinks and the lake layers.

Layers are partitioned Parquet directories under a base path (on a cluster:
the shared store). Every load appends; partition columns give real partition
pruning on later reads. The catalog is an append-only Parquet table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinari.schemas import CATALOG_ENTRY
from opinari.sources import loads
from opinari.sources.files import list_layer


def materialise_once(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write the table unless it is already there, then read it back.
    ``mode('ignore')`` makes the check and the write one step."""
    df.write.mode("ignore").parquet(path)
    return spark.read.parquet(path)


def _layer_path(base: str, layer: str) -> str:
    return f"{base.rstrip('/')}/{layer}"


def load_raw(df: DataFrame, base: str, ingest_date: str | None = None, load_id: str | None = None) -> str:
    """Append to the raw layer, partitioned by ingest date. With a ``load_id`` the load can be repeated:
    see :mod:`opinari.sources.loads`, whose ``read`` then reads the layer. A layer takes one kind only."""
    day = ingest_date or dt.date.today().isoformat()
    path = _layer_path(base, "raw")
    if load_id:
        loads.load(df.withColumn("ingest_date", F.lit(day)), path, load_id, ("ingest_date",))
        return path
    df.withColumn("ingest_date", F.lit(day)).write.mode("append").partitionBy("ingest_date").parquet(path)
    return path


def load_processed(df: DataFrame, base: str, processing_type: str, date: str | None = None,
                   partition_by: tuple[str, ...] = (), load_id: str | None = None) -> str:
    """S10 + S12: snappy Parquet tagged with the processing type, partitioned
    by type and date plus any extra columns (game id, …); ``load_id`` as in :func:`load_raw`."""
    day = date or dt.date.today().isoformat()
    path = _layer_path(base, "processed")
    if load_id:
        tagged = df.withColumn("processing_type", F.lit(processing_type)).withColumn("load_date", F.lit(day))
        loads.load(tagged, path, load_id, ("processing_type", "load_date", *partition_by))
        return path
    (df.withColumn("processing_type", F.lit(processing_type)).withColumn("load_date", F.lit(day))
     .write.mode("append").option("compression", "snappy")
     .partitionBy("processing_type", "load_date", *partition_by).parquet(path))
    return path


def load_curated(spark: SparkSession, df: DataFrame, base: str, dataset_name: str, load_id: str | None = None) -> str:
    """Curated table, one partition per load, plus the load's quality profile
    (A15) appended beside it; earlier loads are not read again. ``load_id`` as in :func:`load_raw`: the profile is
    a load of its own with the same id, made from the committed rows."""
    from opinari.operators.quality import table_profile

    path, load = f"{_layer_path(base, 'curated')}/{dataset_name}", uuid.uuid4().hex
    if load_id:
        loads.load(df, path, load_id)
        this = loads.read(spark, path, load_column="load_id").where(F.col("load_id") == load_id).drop("load_id")
        profile = table_profile(this).withColumn("dataset", F.lit(dataset_name)).withColumn("load_id", F.lit(load_id)) \
            .withColumn("profiled_at", F.current_timestamp())
        loads.load(profile, f"{_layer_path(base, 'curated')}/_profiles", f"{dataset_name}-{load_id}")
        return path
    df.withColumn("load_id", F.lit(load)).write.mode("append").partitionBy("load_id").parquet(path)
    this = spark.read.parquet(f"{path}/load_id={load}")
    profile = table_profile(this).withColumn("dataset", F.lit(dataset_name)).withColumn("load_id", F.lit(load)) \
        .withColumn("profiled_at", F.current_timestamp())
    profile.write.mode("append").parquet(f"{_layer_path(base, 'curated')}/_profiles")
    return path


def catalog_append(spark: SparkSession, base: str, layer: str, path: str,
                   processing_type: str | None = None, since: dt.datetime | None = None) -> DataFrame:
    """One catalog row per load; the size is the sum of the file sizes
    listed under ``path`` (S14), computed by Spark. ``path`` is the load's own
    partition, or ``since`` (taken before the load) leaves earlier files out."""
    files = list_layer(spark, path)
    if since is not None:
        files = files.where(F.col("modificationTime") >= F.lit(since))
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("file_size"))
    row = size.select(F.lit(layer).alias("layer"), F.lit(path).alias("path"),
                      F.col("file_size").cast("long").alias("file_size"),
                      F.current_timestamp().alias("uploaded_at"),
                      F.lit(processing_type).cast("string").alias("processing_type"))
    row = row.select(*[F.col(f.name).cast(f.dataType) for f in CATALOG_ENTRY.fields])
    row.write.mode("append").parquet(f"{base.rstrip('/')}/_catalog")
    return spark.read.parquet(f"{base.rstrip('/')}/_catalog")


def save_model(spark: SparkSession, model, base: str, name: str, version: str,
               metrics: DataFrame | None = None) -> str:
    """Store a fitted pipeline by name and version and append a registry
    row (with its metric row when given)."""
    path = f"{base.rstrip('/')}/models/{name}/{version}"
    model.write().overwrite().save(path)
    reg = spark.range(1).select(F.lit(name).alias("model_name"), F.lit(version).alias("model_version"),
                                F.lit(path).alias("path"), F.current_timestamp().alias("saved_at"))
    if metrics is not None:
        m = metrics.select("accuracy", "precision", "recall", "f1_score").limit(1)
        reg = reg.unionByName(m, allowMissingColumns=True).agg(
            *[F.max(c).alias(c) for c in ["model_name", "model_version", "path", "saved_at", "accuracy",
                                          "precision", "recall", "f1_score"]])
    reg.write.mode("append").parquet(f"{base.rstrip('/')}/models/_registry")
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
