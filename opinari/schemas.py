"""Fixed schemas of the comment tables and the plan-time required-column check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

CATALOG_ENTRY = T.StructType([
    T.StructField("layer", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("file_size", T.LongType()),
    T.StructField("uploaded_at", T.TimestampType()),
    T.StructField("processing_type", T.StringType()),
])

SCORE = T.StructType([
    T.StructField("sentiment", T.StringType()),
    T.StructField("sentiment_confidence", T.DoubleType()),
])


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Fail at plan time (no job runs) when a required column is missing."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return df
