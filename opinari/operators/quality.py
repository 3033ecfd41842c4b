"""Data-quality metrics and reports.

Each profile is one aggregate over the table (partial aggregation on every
task, a final merge of one row per task). Metrics that need per-word or
per-character detail explode first and aggregate once more. Exact medians use
``percentile`` (its partial state is a value→count map, bounded by the number
of distinct values: small for lengths); pass ``exact=False`` for
``percentile_approx`` with bounded state on any column.

Scalar aggregates are combined by union + ``max`` (each column is set in one
input row only), never by a cross join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinari.config import DEFAULT_THRESHOLDS, QUALITY_RULES, SENTIMENT_LABELS, Thresholds
from opinari.functions import text as tx
from opinari.operators.base import key_hash, with_columns_once, written
from opinari.operators.frequent import most_frequent


def _median(c: Column, exact: bool) -> Column:
    return F.median(c) if exact else F.percentile_approx(c, 0.5, 10000)


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Merge one-row aggregates with disjoint columns into one row."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    cols = [c for f in frames for c in f.columns]
    return u.agg(*[F.max(c).alias(c) for c in cols])


def text_length_profile(df: DataFrame, col: str = "cleaned_comment",
                        t: Thresholds = DEFAULT_THRESHOLDS, exact: bool = True) -> DataFrame:
    """A1 over non-null texts."""
    n = F.length(col)
    return df.filter(F.col(col).isNotNull()).agg(
        F.count(F.lit(1)).alias("total_texts"),
        F.avg(n).alias("avg_length"),
        _median(n, exact).cast("double").alias("median_length"),
        F.min(n).alias("min_length"),
        F.max(n).alias("max_length"),
        F.count_if(n == 0).alias("empty_texts"),
        F.count_if(n < t.min_comment_length).alias("very_short_texts"),
        F.count_if(n > t.very_long_text).alias("very_long_texts"),
    )


def readability(df: DataFrame, col: str = "cleaned_comment") -> DataFrame:
    """A2: mean words per sentence over all sentences, sentences per text;
    0 when there are no sentences. No explode, no per-sentence array: two
    counting scans per text."""
    n_sent, n_words = tx.sentence_totals(F.col(col))
    d = df.filter(F.col(col).isNotNull()).select(n_sent.alias("n_sent"), n_words.alias("n_words"))
    agg = d.agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n_sent").alias("s"),
                F.sum("n_words").alias("w"))
    return agg.select(
        F.coalesce(F.try_divide(F.col("w"), F.col("s")), F.lit(0.0)).cast("double").alias("avg_sentence_length"),
        F.when(F.col("s") > 0, F.try_divide(F.col("s"), F.col("n_texts"))).otherwise(F.lit(0.0))
        .cast("double").alias("avg_sentences_per_text"))


def char_diversity(df: DataFrame, col: str = "cleaned_comment") -> DataFrame:
    """A3: distinct lower-cased characters of all texts joined by one space,
    divided by that joined length. Per-row distinct characters are exploded
    and de-duplicated (a shuffle of at most #distinct-chars x #tasks rows);
    the joining space counts when there are two or more texts."""
    texts = df.filter(F.col(col).isNotNull())
    chars = (texts.select(F.explode(F.array_distinct(
        F.regexp_extract_all(F.lower(col), F.lit(r"(?s)(.)"), 1))).alias("ch"))
        .agg(F.count_distinct("ch").alias("distinct_chars"),
             F.max(F.when(F.col("ch") == " ", 1).otherwise(0)).alias("has_space")))
    sizes = texts.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(col)).alias("chars"))
    c = combine_rows(chars, sizes)
    total = F.coalesce(F.col("chars"), F.lit(0)) + F.greatest(F.col("n") - 1, F.lit(0))
    distinct = (F.coalesce(F.col("distinct_chars"), F.lit(0))
                + F.when((F.col("n") >= 2) & (F.coalesce(F.col("has_space"), F.lit(0)) == 0), 1).otherwise(0))
    return c.select(
        distinct.cast("long").alias("unique_chars"), total.cast("long").alias("total_chars"),
        F.when(total > 0, distinct / total).otherwise(F.lit(0.0)).alias("char_diversity"))


def words_long(df: DataFrame, col: str = "cleaned_comment") -> DataFrame:
    return df.filter(F.col(col).isNotNull()).select(F.explode(tx.words(F.col(col))).alias("word"))


def vocabulary(df: DataFrame, col: str = "cleaned_comment", exact: bool = True) -> DataFrame:
    """A4: distinct words, total words, words per text (``exact=False`` uses
    a HyperLogLog sketch for the distinct count)."""
    n_texts = df.filter(F.col(col).isNotNull()).agg(F.count(F.lit(1)).alias("n_texts"))
    distinct = F.count_distinct("word") if exact else F.approx_count_distinct("word")
    w = words_long(df, col).agg(distinct.alias("unique_words"), F.count(F.lit(1)).alias("total_words"))
    c = combine_rows(n_texts, w)
    return c.select(F.coalesce("unique_words", F.lit(0)).alias("unique_words"),
                    F.coalesce("total_words", F.lit(0)).alias("total_words"),
                    F.when(F.col("n_texts") > 0, F.col("total_words") / F.col("n_texts"))
                    .otherwise(F.lit(0.0)).alias("avg_words_per_text"))


def top_words(df: DataFrame, col: str = "cleaned_comment", n: int = 10) -> DataFrame:
    """A5: the ``n`` most frequent words (ties by word), exactly; candidates are counted, not the whole vocabulary
    (:mod:`opinari.operators.frequent`)."""
    return most_frequent(words_long(df, col), "word", n)


def sentiment_distribution(df: DataFrame) -> DataFrame:
    """Count and share (in %) of each label, over all rows."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col("sentiment") == s).alias(s) for s in SENTIMENT_LABELS])
    stack = ", ".join(f"'{s}', `{s}`" for s in SENTIMENT_LABELS)
    long = agg.select("_n", F.expr(f"stack({len(SENTIMENT_LABELS)}, {stack}) AS (sentiment, count)"))
    return long.select("sentiment", "count",
                       F.try_divide(F.col("count") * 100.0, F.col("_n")).alias("percentage"))


def confidence_profile(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS,
                       exact: bool = True) -> DataFrame:
    """A7 over non-null confidences."""
    c = F.col("sentiment_confidence")
    return df.filter(c.isNotNull()).agg(
        F.avg(c).alias("avg_confidence"),
        _median(c, exact).cast("double").alias("median_confidence"),
        F.count_if(c < t.low_confidence).alias("low_confidence_count"),
        F.count_if(c > t.high_confidence).alias("high_confidence_count"))


def quality_conditions(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> list[tuple[float, Column]]:
    """(weight, condition) of each share; each only if its column exists."""
    found = []
    if "cleaned_comment" in df.columns:
        ln = F.length("cleaned_comment")
        found += [(-20.0, ln == 0), (-10.0, ln < t.min_comment_length)]
    if "sentiment_confidence" in df.columns:
        found.append((-15.0, F.col("sentiment_confidence") < t.low_confidence))
    if "detected_aspects" in df.columns:
        found.append((5.0, F.size("detected_aspects") > 0))
    return found


def score_of_shares(terms: list[Column]) -> Column:
    """100 and the weighted shares, held between 0 and 100."""
    # ``least``/``greatest`` skip nulls: a share of no rows must not become a score.
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), reduce(lambda a, b: a + b, terms, F.lit(100.0))))


def quality_score_expr(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> Column:
    n = F.count(F.lit(1))
    return F.when(n > 0, score_of_shares([weight * F.try_divide(F.count_if(c), n) for weight, c in quality_conditions(df, t)]))


def quality_score(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """0–100 score in one aggregate; NULL on an empty table."""
    return df.agg(quality_score_expr(df, t).alias("quality_score"))


def validate_extraction(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Extraction check; the names of all failed rules are listed (the
    reference keeps only the last message). A missing required column is a
    failed rule, and what would be counted in it is null."""
    required = ["game_id", "username", "rating", "value", "cleaned_comment"]
    has_req = all(c in df.columns for c in required)

    def of(col: str, agg: Column, kind: str) -> Column:
        return agg if col in df.columns else F.lit(None).cast(kind)

    agg = df.agg(F.count(F.lit(1)).alias("total_comments"),
                 of("game_id", F.count_distinct("game_id"), "long").alias("unique_games"),
                 of("cleaned_comment", F.count_if(F.col("cleaned_comment").isNull()), "long").alias("empty_comments"),
                 of("cleaned_comment", F.avg(F.length("cleaned_comment")), "double").alias("avg_comment_length"))
    errors = F.array_remove(F.array(
        F.lit("" if has_req else "missing_columns"),
        F.when(F.col("total_comments") < t.min_extraction_rows, F.lit("too_few_rows")).otherwise(""),
        F.when(F.col("empty_comments") > F.col("total_comments") * t.max_missing_share,
               F.lit("too_many_empty")).otherwise("")), "")
    return agg.select("*", F.lit(has_req).alias("has_required_columns"), errors.alias("errors"),
                      (F.size(errors) == 0).alias("is_valid"))


def validate_cleaned(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Cleaned-data check with warnings."""
    n = F.length("cleaned_comment")
    agg = df.agg(F.count(F.lit(1)).alias("total_comments"), F.avg(n).alias("avg_comment_length"),
                 F.min(n).alias("min_comment_length"), F.max(n).alias("max_comment_length"),
                 F.count_if(tx.stripped_shorter("cleaned_comment", 1)).alias("empty_comments"),
                 F.count_distinct("game_id").alias("unique_games"))
    has_meta = "cleaned_at" in df.columns and "comment_length" in df.columns
    warnings = F.array_remove(F.array(
        F.when(F.col("empty_comments") > 0, F.lit("empty_comments")).otherwise(""),
        F.when(F.col("avg_comment_length") < t.short_mean_length, F.lit("short_mean_length")).otherwise("")), "")
    return agg.select("*", F.lit(has_meta).alias("has_metadata"), warnings.alias("warnings"),
                      F.lit(True).alias("is_valid"))


def cleaning_report(original: DataFrame, cleaned: DataFrame, col: str = "cleaned_comment") -> DataFrame:
    """before/after counts, removed rows, removal rate, mean lengths."""
    a = original.agg(F.count(F.lit(1)).alias("original_count"),
                     F.avg(F.length(col)).alias("avg_length_before"))
    b = cleaned.agg(F.count(F.lit(1)).alias("cleaned_count"),
                    F.avg(F.length(col)).alias("avg_length_after"))
    c = combine_rows(a, b)
    removed = F.col("original_count") - F.col("cleaned_count")
    return c.select("original_count", "cleaned_count", removed.alias("removed_count"),
                    F.try_divide(removed.cast("double"), F.col("original_count")).alias("removal_rate"),
                    "avg_length_before", "avg_length_after")


def table_profile(df: DataFrame) -> DataFrame:
    """A15 in long format: one row per column with its type, null count and
    null %, plus table rows, column count and duplicate rows. Duplicates are
    counted by a 128-bit hash of the row (partial aggregation first)."""
    cols = df.columns
    nulls = df.agg(F.count(F.lit(1)).alias("_rows"),
                   *[F.count_if(F.col(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(cols)])
    h1, h2 = key_hash(cols)
    dups = (df.select(h1.alias("_h1"), h2.alias("_h2")).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_k"))
            .agg(F.sum(F.col("_k") - 1).alias("_dups")))
    one = combine_rows(nulls, dups)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    stack = ", ".join(f"'{c}', '{types[c]}', `_null_{i}`" for i, c in enumerate(cols))
    return one.select(
        F.col("_rows").alias("row_count"), F.lit(len(cols)).alias("column_count"),
        F.coalesce(F.col("_dups"), F.lit(0)).alias("duplicate_rows"),
        F.expr(f"stack({len(cols)}, {stack}) AS (column_name, data_type, null_count)")
    ).withColumn("null_percentage", F.try_divide(F.col("null_count") * 100.0, F.col("row_count")))


def language_distribution(df: DataFrame, col: str = "detected_language") -> DataFrame:
    """A16."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def quality_metric_rows(spark: SparkSession, df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS,
                        rules=QUALITY_RULES, extra_metrics: dict[str, Column] | None = None) -> DataFrame:
    """Metric, value, threshold, good/warning/error. The metrics come
    from one aggregate, are stacked to long format and joined with the rule
    table (one row per rule: a bounded broadcast). ``extra_metrics`` (F3) adds
    metrics by name, as aggregates; ``rules`` may judge them."""
    extra = extra_metrics or {}
    n = F.count(F.lit(1))
    ln = F.length("cleaned_comment")
    agg = df.agg(
        F.avg(ln).alias("avg_length"),
        F.try_divide(F.count_if(ln == 0), n).alias("empty_ratio"),
        F.try_divide(F.count_if(ln < t.min_comment_length), n).alias("short_ratio"),
        F.avg("sentiment_confidence").alias("avg_confidence"),
        F.try_divide(F.count_if(F.col("sentiment_confidence") < t.low_confidence), n).alias("low_confidence_ratio"),
        quality_score_expr(df, t).alias("quality_score"), *[c.alias(name) for name, c in extra.items()])
    names = ["avg_length", "empty_ratio", "short_ratio", "avg_confidence", "low_confidence_ratio",
             "quality_score", *extra]
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in names)
    long = agg.select(F.expr(f"stack({len(names)}, {stack}) AS (metric_name, value)"))
    rule_df = spark.createDataFrame([(r.metric_name, float(r.threshold), r.higher_is_better, float(r.warn_margin))
                                     for r in rules],
                                    "metric_name string, threshold double, higher_is_better boolean, margin double")
    j = long.join(F.broadcast(rule_df), "metric_name", "left")
    v, th, m = F.col("value"), F.col("threshold"), F.col("margin")
    status = (F.when(th.isNull() | v.isNull(), F.lit("unknown"))
              .when(F.col("higher_is_better"), F.when(v >= th, "good").when(v >= th - m, "warning").otherwise("error"))
              .otherwise(F.when(v <= th, "good").when(v <= th + m, "warning").otherwise("error")))
    return j.select("metric_name", "value", "threshold", status.alias("status"))


def quality_report(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS, exact: bool = True,
                   top_words: int = 10) -> DataFrame:
    """The combined report as a long table ``(section, metric, value)``.

    One wide aggregate for every scalar metric (A1, A2, A6, A7, text counts of
    A3/A4, aspect total), and one tagged explode of characters, words, aspects
    and aspects by sentiment (A3, A4, A5, A8, A9). Each part would otherwise
    re-read and re-clean the table on its own; what the two need of ``df`` is written
    once, so that its texts are cleaned and scored once. ``exact=False`` takes
    approximate medians, whose state is bounded; the exact ones hold every
    distinct length and confidence."""
    text = "cleaned_comment"
    needed = [text, "sentiment", "sentiment_confidence", "detected_aspects"]
    df = written(df.select(*[c for c in needed if c in df.columns]), "report-rows")
    c = F.col(text)
    nn = c.isNotNull()
    ln = F.when(nn, F.length(c))
    n_sent, n_words = tx.sentence_totals(c)
    metrics: list[tuple[str, str, Column]] = [
        ("text", "total_texts", F.count_if(nn)),
        ("text", "avg_length", F.avg(ln)),
        ("text", "median_length", _median(ln, exact)),
        ("text", "min_length", F.min(ln)),
        ("text", "max_length", F.max(ln)),
        ("text", "empty_texts", F.count_if(ln == 0)),
        ("text", "very_short_texts", F.count_if(ln < t.min_comment_length)),
        ("text", "very_long_texts", F.count_if(ln > t.very_long_text)),
        ("_", "_sent", F.sum(F.when(nn, n_sent))),
        ("_", "_sent_words", F.sum(F.when(nn, n_words))),
        ("_", "_chars", F.sum(ln)),
    ]
    if "sentiment" in df.columns:
        metrics.append(("sentiment", "total_analyzed", F.count(F.lit(1))))
        for s_ in SENTIMENT_LABELS:
            metrics.append(("sentiment", f"{s_}_pct",
                            F.try_divide(F.count_if(F.col("sentiment") == s_) * 100.0, F.count(F.lit(1)))))
    if "sentiment_confidence" in df.columns:
        conf = F.col("sentiment_confidence")
        metrics += [("confidence", "avg_confidence", F.avg(conf)),
                    ("confidence", "median_confidence", _median(conf, exact)),
                    ("confidence", "low_confidence_count", F.count_if(conf < t.low_confidence)),
                    ("confidence", "high_confidence_count", F.count_if(conf > t.high_confidence))]
    if "detected_aspects" in df.columns:
        metrics.append(("absa", "total_with_aspects", F.count_if(F.size("detected_aspects") > 0)))
    one = df.agg(*[m.cast("double").alias(f"m{i}") for i, (_, _, m) in enumerate(metrics)])
    names = {name: f"m{i}" for i, (_, name, _) in enumerate(metrics)}
    # Second pass: distinct characters, words and aspects of every row, by kind, in
    # one explode and one grouped count (partial counts map-side); characters by an
    # empty pattern, which splits without a regular expression per character. Aspect
    # counts leave the aggregate as one list (at most one entry per lexicon aspect and
    # label). The grouped items are written once, and the most frequent words are
    # taken from the same table.
    none = F.array().cast("array<string>")
    low = F.col("_low")
    lists = {"char": F.when(low.isNotNull(), F.array_distinct(F.split(low, ""))).otherwise(none),
             "word": F.when(low.isNotNull(), tx.words(low, lowered=True)).otherwise(none)}
    if "detected_aspects" in df.columns:
        found = F.coalesce(F.col("detected_aspects"), none)
        lists["aspect"] = found
        if "sentiment" in df.columns:
            lists["aspect"] = F.concat(found, F.transform(found, lambda x: F.concat(x, F.lit("_"), F.col("sentiment"))))
    kinds = F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), x.alias("items")) for k, x in lists.items()]))
    items = with_columns_once(df, _low=F.lower(c)).select(kinds).select("kind", F.explode("items").alias("item")) \
        .where("item is not null and (kind <> 'char' or item <> '')").groupBy("kind", "item").agg(F.count(F.lit(1)).alias("n"))
    items = written(items, "report-items")
    kind = F.col("kind")
    stats = items.agg(F.count_if(kind == "char").alias("dc"),
                      F.max(F.when((kind == "char") & (F.col("item") == " "), 1).otherwise(0)).alias("hs"),
                      F.count_if(kind == "word").alias("uw"),
                      F.sum(F.when(kind == "word", F.col("n"))).alias("tw"),
                      F.collect_list(F.when(kind == "aspect", F.struct(F.col("item").alias("a"), F.col("n").alias("n")))).alias("asp"))
    # One row with every scalar: each input aggregate runs exactly once.
    row = combine_rows(one, stats)
    n, sent, sent_words = F.col(names["total_texts"]), F.col(names["_sent"]), F.col(names["_sent_words"])
    total = F.coalesce(F.col(names["_chars"]), F.lit(0.0)) + F.greatest(n - 1, F.lit(0.0))
    distinct = (F.coalesce(F.col("dc"), F.lit(0))
                + F.when((n >= 2) & (F.coalesce(F.col("hs"), F.lit(0)) == 0), 1).otherwise(0))
    row = row.select(
        "*",
        F.coalesce(F.try_divide(sent_words, sent), F.lit(0.0)).alias("_avg_sentence_length"),
        F.when(sent > 0, F.try_divide(sent, n)).otherwise(F.lit(0.0)).alias("_avg_sentences_per_text"),
        F.when(total > 0, distinct / total).otherwise(F.lit(0.0)).alias("_char_diversity"),
        F.coalesce(F.col("uw"), F.lit(0)).cast("double").alias("_unique_words"),
        F.coalesce(F.col("tw"), F.lit(0)).cast("double").alias("_total_words"),
        F.when(n > 0, F.coalesce(F.col("tw"), F.lit(0)) / n).otherwise(F.lit(0.0)).alias("_avg_words_per_text"))
    rows = [(sec, name, names[name]) for sec, name, _ in metrics if sec != "_"]
    rows += [("readability", "avg_sentence_length", "_avg_sentence_length"),
             ("readability", "avg_sentences_per_text", "_avg_sentences_per_text"),
             ("language", "char_diversity", "_char_diversity"),
             ("language", "unique_words", "_unique_words"),
             ("language", "total_words", "_total_words"),
             ("language", "avg_words_per_text", "_avg_words_per_text")]
    out = F.array(*[F.struct(F.lit(sec).alias("section"), F.lit(name).alias("metric"),
                             F.col(col).cast("double").alias("value")) for sec, name, col in rows])
    if "detected_aspects" in df.columns:
        out = F.concat(out, F.transform(F.coalesce(F.col("asp"), F.array()), lambda x: F.struct(
            F.lit("absa").alias("section"), F.concat(F.lit("aspect_"), x["a"]).alias("metric"),
            x["n"].cast("double").alias("value"))))
    words = items.filter(kind == "word").orderBy(F.desc("n"), "item").limit(top_words).select(
        F.lit("top_words").alias("section"), F.col("item").alias("metric"), F.col("n").cast("double").alias("value"))
    return row.select(F.inline(out)).union(words)
