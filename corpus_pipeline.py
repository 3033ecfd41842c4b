"""Corpus pipeline: language ID, near-duplicate removal, benchmark
decontamination, secret redaction, packing. Each stage is one operator of
``opinari.llm`` and works on all rows that its predecessor kept; all but the
last return the columns of ``documents``.

Null and empty texts have no language and go in the first stage; rows
without an id go through to the end; extra columns go along until packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opinari.llm import decontam, langid, neardup, packing, secrets, tokens
from opinari.llm.common import documents, written
from opinari.llm.queries import vocabulary_path


#: The bound of an Arrow batch here. By default a batch has 10,000 texts and up to 64 MB; executor and worker
#: hold several copies of it, and what one stage has taken of their memory the next ones find taken.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", "1m")


def _small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches, unless it has a bound of its own."""
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)


def _length(docs: DataFrame) -> str | None:
    return "n_chars" if "n_chars" in docs.columns else None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language."""
    _small_batches(spark)
    return langid.language_stage(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    _small_batches(spark)
    return neardup.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut benchmark passages out; drop documents that are mostly benchmark."""
    _small_batches(spark)
    return decontam.remove_spans(docs, documents(spark, sf_dir, "benchmark"), length=_length(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark."""
    return secrets.redact(docs, length=_length(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, one row per piece. Workers remember less than
    in a job of its own: the stages before have grown their executors."""
    _small_batches(spark)
    return packing.pack(packing.pieces(docs, tokens.load(vocabulary_path()), remembered=300_000, merges=20_000))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("redact_secrets", redact_secrets), ("pack", pack)]

#: Fitted models, sketches and a tokenizer: not SQL. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
