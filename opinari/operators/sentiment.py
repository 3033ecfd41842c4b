"""Sentiment scoring (M6, M7), with the "score each distinct text once" plan
shapes (J2–J4) and the Python-model extension point (F1).

Three back ends share one output schema ``(sentiment, sentiment_confidence)``:

* ``score_lexicon``   — pure Catalyst expressions, no Python, no shuffle;
* ``score_ml``        — a fitted Spark ML ``PipelineModel`` (M3);
* ``score_with_model``— any Python model through an Arrow-batched iterator
  ``pandas_udf``; the model is loaded once per Python worker, and a failing
  batch is retried row by row so one bad text yields ``('unknown', 0.0)``
  instead of failing the job (M7).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinari.config import CLASS_LABELS, LexiconScorer
from opinari.functions import sentiment as fs
from opinari.functions import text as tx
from opinari.operators.base import join_hot, with_columns_once
from opinari.schemas import SCORE, require_columns


def score_lexicon(df: DataFrame, scorer: LexiconScorer, text_col: str = "cleaned_comment") -> DataFrame:
    require_columns(df, text_col)
    s = fs.lexicon_score(F.col(text_col), scorer)
    return (df.withColumn("_s", s)
            .withColumn("sentiment", F.col("_s.sentiment"))
            .withColumn("sentiment_confidence", F.col("_s.sentiment_confidence"))
            .drop("_s"))


def score_ml(df: DataFrame, model, text_col: str = "cleaned_comment") -> DataFrame:
    """M6 with a fitted pipeline that reads a ``text`` column and outputs
    ``probability`` (see ``operators.ml``). Null/blank text →
    ``('unknown', 0.0)``. Columns of ``df`` are kept unchanged."""
    from pyspark.ml.functions import vector_to_array

    require_columns(df, text_col)
    src = "_orig_text" if text_col == "text" else text_col
    inp = df.withColumnRenamed("text", "_orig_text") if "text" in df.columns else df
    inp = inp.withColumn("text", F.coalesce(F.col(src), F.lit("")))
    out = model.transform(inp)
    p = vector_to_array("probability")
    blank = F.length(F.trim(F.col("text"))) == 0
    label = (F.when(blank, F.lit("unknown"))
             .when(p[1] > p[0], F.lit(CLASS_LABELS[1])).otherwise(F.lit(CLASS_LABELS[0])))
    conf = F.when(blank, F.lit(0.0)).otherwise(F.greatest(p[0], p[1]))
    keep = [F.col("_orig_text").alias("text") if c == "text" else F.col(c) for c in df.columns]
    return with_columns_once(out.select(*keep, F.struct(label.alias("l"), conf.alias("c")).alias("_r")),
                             sentiment=F.col("_r.l"), sentiment_confidence=F.col("_r.c")).drop("_r")


def model_scorer_udf(load_model: Callable[[], Callable[[list[str]], list[tuple[str, float]]]]):
    """build an iterator ``pandas_udf`` around a Python model.

    ``load_model`` runs once per Python worker and returns ``predict(texts) ->
    [(label, confidence), ...]``. Batches arrive as Arrow record batches; a
    failing batch is retried per text, and a failing text gives
    ``('unknown', 0.0)``."""

    @F.pandas_udf(SCORE)
    def _score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = load_model()
        for texts in batches:
            items = texts.fillna("").tolist()
            try:
                res = list(predict(items))
            except Exception:  # noqa: BLE001 - per-text fallback (M7)
                res = []
                for t in items:
                    try:
                        res.append(tuple(predict([t])[0]))
                    except Exception:  # noqa: BLE001
                        res.append(("unknown", 0.0))
            out = pd.DataFrame(res, columns=["sentiment", "sentiment_confidence"])
            blank = texts.isna() | (texts.fillna("").str.strip() == "")
            out.loc[blank.values, "sentiment"] = "unknown"
            out.loc[blank.values, "sentiment_confidence"] = 0.0
            yield out

    return _score


def score_with_model(df: DataFrame, udf, text_col: str = "cleaned_comment") -> DataFrame:
    """The model runs once per row; filters on its columns stay above it."""
    out = with_columns_once(df, _s=udf(F.col(text_col)))
    return out.select(*df.columns, "_s.sentiment", "_s.sentiment_confidence")


def score_distinct(df: DataFrame, score_fn: Callable[[DataFrame, str], DataFrame],
                   text_col: str = "cleaned_comment") -> DataFrame:
    """Score every distinct text once and spread the result to all rows.

    Grouping aggregates map-side first, so a text repeated in a third of all
    rows shrinks to one row per partition before the shuffle; the expensive
    scorer then sees each text once. The join back is on the MD5 key, with hot
    texts by broadcast (``join_hot``). Null texts have no key and are
    ``('unknown', 0.0)``. Catalyst does not dedupe UDF calls by value, so this is
    an explicit plan choice for costly scorers (for the lexicon scorer it is not
    needed)."""
    keyed = df.withColumn("text_key", tx.text_key(F.col(text_col)))
    counts = keyed.where(F.col("text_key").isNotNull()).groupBy("text_key", text_col).agg(F.count(F.lit(1)).alias("_rows"))
    scores = score_fn(counts, text_col).select("text_key", "_rows", "sentiment", "sentiment_confidence")
    out = join_hot(keyed, scores, "text_key", "_rows", df.count())
    none = F.col("text_key").isNull()
    return out.withColumn("sentiment", F.when(none, F.lit("unknown")).otherwise(F.col("sentiment"))) \
        .withColumn("sentiment_confidence", F.when(none, F.lit(0.0)).otherwise(F.col("sentiment_confidence")))


def unscored(df: DataFrame, scores: DataFrame, text_col: str = "cleaned_comment") -> DataFrame:
    """Rows whose text has no score yet (anti join on the text key); null
    texts need none."""
    keyed = df.where(F.col(text_col).isNotNull()).withColumn("text_key", tx.text_key(F.col(text_col)))
    return keyed.join(scores.select("text_key"), "text_key", "left_anti")


def already_scored(df: DataFrame, scores: DataFrame, text_col: str = "cleaned_comment") -> DataFrame:
    """Rows whose text is already scored (semi join on the text key)."""
    keyed = df.withColumn("text_key", tx.text_key(F.col(text_col)))
    return keyed.join(scores.select("text_key"), "text_key", "left_semi")


def incremental_scores(df: DataFrame, scores: DataFrame,
                       score_fn: Callable[[DataFrame, str], DataFrame],
                       text_col: str = "cleaned_comment") -> DataFrame:
    """J3 then score: new ``(text_key, sentiment, sentiment_confidence)`` rows
    to append to the score table."""
    new = unscored(df, scores, text_col).select("text_key", text_col).distinct()
    return score_fn(new, text_col).select("text_key", "sentiment", "sentiment_confidence")


SCORE_TABLE = T.StructType([
    T.StructField("text_key", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("sentiment_confidence", T.DoubleType()),
])
