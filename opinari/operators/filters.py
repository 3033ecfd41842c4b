"""Row filters and row checks (P2–P14). All are narrow transformations except
the per-request count of P11, which is a partial aggregate joined back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.config import ANALYSIS_TYPES, DEFAULT_THRESHOLDS, Lexicon, Thresholds
from opinari.functions import text as tx
from opinari.operators.base import join_hot, with_columns_once
from opinari.schemas import require_columns


def drop_null_text(df: DataFrame, col: str = "value") -> DataFrame:
    """P2."""
    return require_columns(df, col).na.drop(subset=[col])


def min_length(df: DataFrame, col: str = "value", n: int = 10) -> DataFrame:
    """Strict ``len > n``."""
    return df.filter(F.length(col) > n)


def length_range(df: DataFrame, col: str = "cleaned_comment", lo: int = 10,
                 hi: int = 5000) -> DataFrame:
    """Inclusive ``lo <= len <= hi``."""
    return df.filter(F.length(col).between(lo, hi))


def drop_blank(df: DataFrame, col: str = "cleaned_comment") -> DataFrame:
    """P5: drop empty text (after stripping whitespace)."""
    return df.filter(~tx.stripped_shorter(F.col(col), 1))


def language_filter(df: DataFrame, col: str = "detected_language",
                    languages=("en",)) -> DataFrame:
    """Keep the listed languages; no filter when the list is empty."""
    if not languages:
        return df
    return df.filter(F.col(col).isin(list(languages)))


def comment_filter(df: DataFrame, text_col: str = "value",
                   thresholds: Thresholds = DEFAULT_THRESHOLDS,
                   char_filter: bool = True) -> DataFrame:
    """P2 → P3a → T1 → P5: drop null and short raw text, clean, drop empty."""
    require_columns(df, text_col)
    out = min_length(drop_null_text(df, text_col), text_col, thresholds.min_comment_length)
    out = with_columns_once(out, cleaned_comment=tx.clean_text(F.col(text_col), char_filter))
    return out.filter(F.length("cleaned_comment") > 0)


def request_rule_failures(df: DataFrame, text_col: str, request_col: str,
                          thresholds: Thresholds = DEFAULT_THRESHOLDS,
                          extra_rules: dict[str, Column] | None = None) -> DataFrame:
    """Array of failed rule names per row.

    Rules: text not blank, text at most ``max_comment_chars`` long, and at most
    ``max_request_comments`` texts per request. The per-request count is a
    partial aggregate (map-side combined, so a request holding a third of all
    rows costs one row per partition in the shuffle) joined back on the key,
    hot requests by broadcast; a window over the request would put a hot
    request into one task.
    ``extra_rules`` adds user rules (F3): name → Column that is true on failure.
    """
    sizes = df.groupBy(request_col).agg(F.count(F.lit(1)).alias("_request_size"))
    t = F.col(text_col)
    rules = {
        "blank_comment": t.isNull() | (F.length(F.regexp_replace(t, tx.J_WS_RUN, "")) < 1),
        "comment_too_long": F.length(t) > thresholds.max_comment_chars,
        "too_many_comments": F.col("_request_size") > thresholds.max_request_comments,
    }
    rules.update(extra_rules or {})
    failed = F.filter(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]),
                      lambda x: x.isNotNull())
    sizes = sizes.withColumn("_weight", F.col("_request_size"))
    return (join_hot(df, sizes, request_col, "_weight", df.count())
            .withColumn("failed_rules", failed)
            .withColumn("is_valid", F.size("failed_rules") == 0)
            .drop("_request_size"))


def aspect_request_failures(df: DataFrame, aspects_col: str, type_col: str,
                            lexicon: Lexicon, extra_rules: dict[str, Column] | None = None) -> DataFrame:
    """Requested aspects must be known and, if given, not empty; the
    analysis type must be one of sentiment / absa / both. ``extra_rules`` adds
    user rules (F3): name → Column that is true on failure."""
    known = F.array(*[F.lit(n) for n in lexicon.names])
    req = F.col(aspects_col)
    rules = [
        F.when(req.isNotNull() & (F.size(req) == 0), F.lit("empty_aspects")),
        F.when(req.isNotNull() & (F.size(F.array_except(req, known)) > 0), F.lit("unknown_aspect")),
        F.when(~F.coalesce(F.col(type_col).isin(list(ANALYSIS_TYPES)), F.lit(False)),
               F.lit("unknown_analysis_type")),
        *[F.when(cond, F.lit(name)) for name, cond in (extra_rules or {}).items()],
    ]
    failed = F.filter(F.array(*rules), lambda x: x.isNotNull())
    return (df.withColumn("unknown_aspects", F.array_except(F.coalesce(req, F.array().cast("array<string>")), known))
            .withColumn("failed_rules", failed)
            .withColumn("is_valid", F.size("failed_rules") == 0))


def comments_page(df: DataFrame, game_id: str | None = None, limit: int = 100,
                  offset: int = 0, order_col: str = "comment_id") -> DataFrame:
    """Optional game filter, stable order, offset and limit. The game
    filter is pushed to the scan; ordering+limit runs as a top-k per
    partition (TakeOrderedAndProject), not a global sort."""
    if game_id is not None:
        df = df.filter(F.col("game_id") == game_id)
    return df.orderBy(order_col).offset(offset).limit(limit)
