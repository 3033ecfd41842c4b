"""End-to-end jobs: the cleaning job (P2–P10, W1, T4, T9), the aspect-sentiment
job (M8) and the batch-inference job (M11). Each is one lazy plan; nothing is
collected to the driver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinari.config import (DEFAULT_THRESHOLDS, FIXTURE_LEXICON, FIXTURE_SCORER, CleaningConfig,
                            Lexicon, LexiconScorer, Thresholds)
from opinari.functions import text as tx
from opinari.operators import aspects as ops_aspects
from opinari.operators import filters
from opinari.operators.base import with_columns_once
from opinari.operators.dedup import dedup_first
from opinari.operators.lemma import deep_clean
from opinari.operators.sentiment import score_lexicon


def collect_clean(comments: DataFrame, thresholds: Thresholds = DEFAULT_THRESHOLDS,
                  languages=(), char_filter: bool = True) -> DataFrame:
    """Library cleaning step: P2 → P3a → T1 → P5 → P8, then the optional
    English fallback filter (T8 + P6) when ``languages`` contains ``en``."""
    out = filters.comment_filter(comments, "value", thresholds, char_filter)
    if "rating" in out.columns:
        out = out.withColumn("rating", tx.coerce_rating(F.col("rating")))
    if languages:
        out = out.withColumn("detected_language",
                             F.when(tx.is_english_fallback(F.col("cleaned_comment")), F.lit("en"))
                             .otherwise(F.lit("unknown")))
        out = filters.language_filter(out, "detected_language", languages)
    return out


def absa_job(comments: DataFrame, lexicon: Lexicon = FIXTURE_LEXICON,
             scorer: LexiconScorer = FIXTURE_SCORER, use_context: bool = True) -> DataFrame:
    """M8 over raw comments: clean, find aspects, keep rows with aspects,
    score once per comment, spread the label to the aspects."""
    cleaned = filters.comment_filter(comments, "value")
    return ops_aspects.absa(cleaned, lexicon, scorer, "cleaned_comment", use_context)


def aspect_summary_job(comments: DataFrame, lexicon: Lexicon = FIXTURE_LEXICON,
                       scorer: LexiconScorer = FIXTURE_SCORER) -> DataFrame:
    """The main report: A10 over M8."""
    return ops_aspects.aspect_summary(absa_job(comments, lexicon, scorer), lexicon)


def batch_inference(df: DataFrame, analysis_type: str, lexicon: Lexicon = FIXTURE_LEXICON,
                    scorer=FIXTURE_SCORER, text_col: str = "cleaned_comment",
                    model_version: str = "lexicon-1") -> DataFrame:
    """Sentiment, aspects or both over a table, with a model version
    column. Rows without aspects keep an empty aspect list in ``both``."""
    if analysis_type not in ("sentiment", "absa", "both"):
        raise ValueError(f"unknown analysis type {analysis_type}")
    out = df
    if analysis_type in ("sentiment", "both"):
        out = score_lexicon(out, scorer, text_col) if isinstance(scorer, LexiconScorer) else scorer(out, text_col)
    if analysis_type == "absa":
        out = ops_aspects.absa(out, lexicon, scorer, text_col)
    elif analysis_type == "both":
        out = ops_aspects.add_aspect_sentiments(ops_aspects.add_aspects(out, lexicon, text_col))
    return out.withColumn("model_version", F.lit(model_version))


def light_clean(comments: DataFrame, text_col: str = "value") -> DataFrame:
    """The extractor's table: T3 text in ``cleaned_comment``; empty text is
    missing, as after a CSV round trip."""
    out = with_columns_once(comments, cleaned_comment=tx.clean_text_tags(F.col(text_col)))
    return out.withColumn("cleaned_comment", F.when(F.col("cleaned_comment") != "", F.col("cleaned_comment")))


def clean_job(comments: DataFrame, detect: Callable[[DataFrame], DataFrame] | None = None,
              config: CleaningConfig = CleaningConfig(), thresholds: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The ETL cleaning job (daily DAG's clean step), in the reference order, on
    light-cleaned text (T3): W1 duplicates of (game, T3 text) → T4 deep clean
    of the T3 text → P3b length range → language of the cleaned text → P6 → P5
    → P7 → P8/P9 → P10 metadata. ``detect`` adds ``detected_language`` from
    ``cleaned_comment`` (T9); it is needed unless no language is asked for."""
    if config.supported_languages and detect is None:
        raise ValueError("a language filter needs a language detector")
    d = dedup_first(light_clean(comments), ["game_id", "cleaned_comment"], "comment_id")
    # The deep clean writes rows and tokens once; lemmas and language are found in their row after that.
    d = d.drop("value").withColumnRenamed("cleaned_comment", "_light")
    d = deep_clean(d, "_light", "cleaned_comment", "comment_id", config).drop("_light")
    d = filters.length_range(d, "cleaned_comment", thresholds.clean_min_length,
                             thresholds.clean_max_length)
    if config.supported_languages:
        d = filters.language_filter(detect(d), "detected_language", config.supported_languages)
    d = filters.drop_blank(d, "cleaned_comment")
    d = d.withColumn("username", tx.clean_username(F.col("username")))
    d = d.withColumn("rating", tx.rating_or_zero(F.col("rating")))
    return (d.withColumn("cleaned_at", F.current_timestamp())
            .withColumn("comment_length", F.length("cleaned_comment")))
