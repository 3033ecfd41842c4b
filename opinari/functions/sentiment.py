"""Sentiment expressions: class scores to label (T14) and the SQL lexicon
scorer (one of the M6 back ends)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from opinari.config import CLASS_LABELS, LexiconScorer


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def scores_to_label(logit_negative, logit_positive) -> Column:
    """Two class scores -> struct(sentiment, sentiment_confidence,
    p_negative, p_positive). Argmax with ties to the lower class; confidence is
    the larger softmax probability (softmax of two = sigmoid of the margin)."""
    margin = _c(logit_positive).cast("double") - _c(logit_negative).cast("double")
    p = sigmoid(margin)
    label = F.when(margin > 0, F.lit(CLASS_LABELS[1])).otherwise(F.lit(CLASS_LABELS[0]))
    return F.struct(label.alias("sentiment"),
                    F.greatest(p, F.lit(1.0) - p).alias("sentiment_confidence"),
                    (F.lit(1.0) - p).alias("p_negative"),
                    p.alias("p_positive"))


def _present(low: Column, words) -> Column:
    n = F.lit(0)
    for w in words:
        n = n + F.when(low.contains(w), F.lit(1)).otherwise(F.lit(0))
    return n


def lexicon_score(text, scorer: LexiconScorer) -> Column:
    """M6 lexicon back end + M7: struct(sentiment, sentiment_confidence).

    ``x = #positive words present - #negative words present`` (substring on the
    lower-cased text); positive when ``x > 0`` else negative; confidence is
    ``max(p, 1-p)`` with ``p = sigmoid(x)``. Null or blank text gives
    ``('unknown', 0.0)``."""
    low = F.lower(_c(text))
    x = _present(low, scorer.positive) - _present(low, scorer.negative)
    p = sigmoid(x)
    blank = _c(text).isNull() | (F.length(F.trim(_c(text))) == 0)
    label = (F.when(blank, F.lit("unknown"))
             .when(x > 0, F.lit(CLASS_LABELS[1]))
             .otherwise(F.lit(CLASS_LABELS[0])))
    conf = F.when(blank, F.lit(0.0)).otherwise(F.greatest(p, F.lit(1.0) - p))
    return F.struct(label.alias("sentiment"), conf.alias("sentiment_confidence"))
