"""Aspect operators: extraction (T13, P13), keyword join (J5), counts (A8, A9),
the aspect summary (A10) and the end-to-end aspect-sentiment job (M8).

Shuffle profile: extraction and scoring are narrow. The summaries explode at
most ``len(lexicon)`` rows per comment and aggregate with a map-side partial
step, so each shuffle carries ``#aspects x #partitions`` rows whatever the
data size, and a hot aspect cannot skew a reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinari.config import SENTIMENT_LABELS, Lexicon, LexiconScorer
from opinari.functions import aspects as fa
from opinari.operators.base import with_columns_once
from opinari.operators.keywords import gram_hits
from opinari.schemas import require_columns


#: Up to so many rows a lexicon is a literal array in the plan; above, texts and keywords meet by character grams.
LITERAL_LEXICON = 500


def add_aspects(df: DataFrame, lexicon: Lexicon, text_col: str = "cleaned_comment",
                use_context: bool = True) -> DataFrame:
    """``detected_aspects`` array column."""
    require_columns(df, text_col)
    return with_columns_once(
        df, detected_aspects=fa.extract_aspects(F.col(text_col), lexicon, use_context))


def keep_with_aspects(df: DataFrame) -> DataFrame:
    """P13."""
    return df.filter(F.size("detected_aspects") > 0)


def add_aspect_sentiments(df: DataFrame) -> DataFrame:
    """Every found aspect takes the comment's label (and confidence)."""
    require_columns(df, "detected_aspects", "sentiment")
    out = df.withColumn("aspect_sentiments", fa.aspect_sentiments("detected_aspects", "sentiment"))
    if "sentiment_confidence" in df.columns:
        out = out.withColumn("aspect_confidences",
                             fa.aspect_confidences("detected_aspects", "sentiment_confidence"))
    return out


def lexicon_table(spark: SparkSession, lexicon: Lexicon) -> DataFrame:
    """The lexicon as a table ``(aspect, keyword, position)``; distinct pairs."""
    rows, seen = [], set()
    for i, a in enumerate(lexicon.aspects):
        for k in a.keywords:
            if (a.name, k) not in seen:
                seen.add((a.name, k))
                rows.append((a.name, k, i))
    return spark.createDataFrame(rows, "aspect string, keyword string, position int")


def keyword_hits(df: DataFrame, lexicon_df: DataFrame, id_col: str,
                 text_col: str = "cleaned_comment") -> DataFrame:
    """Comment x keyword theta join on substring, long format.

    A small lexicon becomes a literal array, whose matching entries each comment
    lists and explodes: no join, no shuffle of the comment table. One of any other
    size goes through :func:`opinari.operators.keywords.gram_hits`. Rows without a keyword match nothing."""
    lexicon_df = lexicon_df.select("aspect", "keyword").where("keyword is not null").distinct()
    words = lexicon_df.limit(LITERAL_LEXICON + 1).collect()
    if len(words) > LITERAL_LEXICON:
        return gram_hits(df, lexicon_df, id_col, text_col)
    rows = df.select(id_col, F.lower(F.col(text_col)).alias("_low"))
    if not words:
        return rows.limit(0).select(id_col, F.lit("").alias("aspect"), F.lit("").alias("keyword"))
    lexicon = F.array(*[F.struct(F.lit(r["aspect"]).alias("aspect"), F.lit(r["keyword"]).alias("keyword")) for r in words])
    return rows.select(id_col, F.inline(F.filter(lexicon, lambda x: F.col("_low").contains(x["keyword"]))))


def aspect_counts(df: DataFrame) -> DataFrame:
    """Comments per aspect, most frequent first (ties by name)."""
    return (df.select(F.explode("detected_aspects").alias("aspect"))
            .groupBy("aspect").agg(F.count(F.lit(1)).alias("comment_count"))
            .orderBy(F.desc("comment_count"), "aspect"))


def aspect_sentiment_counts(df: DataFrame) -> DataFrame:
    """Aspect x sentiment counts, one column per label (fixed pivot list,
    so no extra job is run to find the pivot values)."""
    exploded = df.select(F.explode("aspect_sentiments").alias("aspect", "sentiment"))
    return (exploded.groupBy("aspect").pivot("sentiment", list(SENTIMENT_LABELS))
            .agg(F.count(F.lit(1))).na.fill(0, list(SENTIMENT_LABELS)))


def aspect_summary(df: DataFrame, lexicon: Lexicon) -> DataFrame:
    """A10: per aspect total, positive, negative, unknown and the two
    percentages; aspects without rows are left out; lexicon order."""
    require_columns(df, "aspect_sentiments")
    e = df.select(F.explode("aspect_sentiments").alias("aspect", "sentiment"))
    agg = e.groupBy("aspect").agg(
        F.count(F.lit(1)).alias("total_comments"),
        F.count_if(F.col("sentiment") == "positive").alias("positive_count"),
        F.count_if(F.col("sentiment") == "negative").alias("negative_count"),
        F.count_if(F.col("sentiment") == "unknown").alias("unknown_count"),
    )
    pct = lambda c: F.col(c) * 100.0 / F.col("total_comments")
    return (agg.withColumn("positive_percentage", pct("positive_count"))
            .withColumn("negative_percentage", pct("negative_count"))
            .withColumn("_pos", fa.lexicon_position("aspect", lexicon))
            .orderBy("_pos").drop("_pos"))


def absa(df: DataFrame, lexicon: Lexicon, scorer, text_col: str = "cleaned_comment",
         use_context: bool = True) -> DataFrame:
    """M8: T13 → P13 → M6 → T15, one lazy plan with no shuffle.

    ``scorer`` is a function ``(DataFrame, text_col) -> DataFrame`` adding
    ``sentiment`` and ``sentiment_confidence`` (see ``operators.sentiment``),
    or a :class:`LexiconScorer`. The comment is scored once, not once per
    aspect."""
    from opinari.operators.sentiment import score_lexicon

    found = keep_with_aspects(add_aspects(df, lexicon, text_col, use_context))
    if isinstance(scorer, LexiconScorer):
        scored = score_lexicon(found, scorer, text_col)
    else:
        scored = scorer(found, text_col)
    return add_aspect_sentiments(scored)
