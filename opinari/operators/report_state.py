"""Reports kept up to date (A21, A13, E6): mergeable partial states of the quality report.

Each load leaves a small state beside its rows; a report merges states and reads no text
again. A state is a long table ``(kind, item, n, x, sketch)``::

    count, <name>      n: rows that the metric counts
    sum, <name>        x: a sum of doubles
    min | max, <name>  n: an extreme
    kll, <name>        sketch: quantiles of a double
    hll, <name>        sketch: distinct words
    char | word | aspect | length, <value>    n: how often the value occurs

Merging two states is one grouped aggregate and gives a state again, so old ones may
be replaced by their merger (:func:`merge`). Counts, extremes, character set, words, aspects and
the median length are those of all rows together. The median confidence is a
sketch's, of rank error below 0.2 % (k = 4,000); with ``exact_words=False`` the distinct
words are a sketch's as well, of relative standard error 1 %, and no word row is read but for the top words.

Defined results: null texts count as rows without a text, empty texts as texts; an optional column
(``sentiment``, ``sentiment_confidence``, ``detected_aspects``) that only some loads have is reported over
those loads; empty loads change nothing; without any row counts are 0 and means null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opinari.config import DEFAULT_THRESHOLDS, SENTIMENT_LABELS, Thresholds
from opinari.functions import text as tx
from opinari.operators.base import with_columns_once, written
from opinari.operators.quality import score_of_shares
from opinari.sources import loads

KLL_K = 4000
HLL_BITS = 14
STATE = "kind string, item string, n long, x double, sketch binary"
#: Kinds whose rows are few, one per metric; the others have a row per value.
FIXED = ("count", "sum", "min", "max", "kll", "hll")


def _row(kind: str, item: str, n: Column | None = None, x: Column | None = None, sketch: Column | None = None) -> Column:
    value = lambda c, to: F.lit(None).cast(to) if c is None else c.cast(to)
    return F.struct(F.lit(kind).alias("kind"), F.lit(item).alias("item"), value(n, "long").alias("n"),
                    value(x, "double").alias("x"), value(sketch, "binary").alias("sketch"))


def _fixed_rows(df: DataFrame, t: Thresholds) -> list[tuple]:
    """(kind, item, aggregate) of every metric that the columns of ``df`` allow."""
    c = F.col("cleaned_comment")
    length = F.length(c)
    sentences, words = tx.sentence_totals(c)
    has = F.when(c.isNotNull(), 1)
    rows = [("count", "rows", F.count(F.lit(1))), ("count", "texts", F.count(has)), ("count", "chars", F.sum(length)),
            ("min", "length", F.min(length)), ("max", "length", F.max(length)),
            ("count", "empty", F.count_if(length == 0)), ("count", "very_short", F.count_if(length < t.min_comment_length)),
            ("count", "very_long", F.count_if(length > t.very_long_text)),
            ("count", "sentences", F.sum(F.when(c.isNotNull(), sentences))),
            ("count", "sentence_words", F.sum(F.when(c.isNotNull(), words)))]
    if "sentiment" in df.columns:
        rows += [("count", "analyzed", F.count(F.lit(1)))]
        rows += [("count", f"label_{s}", F.count_if(F.col("sentiment") == s)) for s in SENTIMENT_LABELS]
    if "sentiment_confidence" in df.columns:
        conf = F.col("sentiment_confidence").cast("double")
        rows += [("count", "confidences", F.count(conf)), ("sum", "confidence", F.sum(conf)),
                 ("count", "low_confidence", F.count_if(conf < t.low_confidence)),
                 ("count", "high_confidence", F.count_if(conf > t.high_confidence)),
                 ("kll", "confidence", F.kll_sketch_agg_double(conf, KLL_K))]
    if "detected_aspects" in df.columns:
        rows.append(("count", "with_aspects", F.count_if(F.size("detected_aspects") > 0)))
    return rows


def state(df: DataFrame, t: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The state of one load: one wide aggregate, and one grouped count of characters, words, aspects and lengths,
    summed on each task before the shuffle."""
    fixed = _fixed_rows(df, t)
    one = df.agg(*[agg.alias(f"m{i}") for i, (_, _, agg) in enumerate(fixed)])
    place = {"kll": "sketch", "sum": "x"}
    totals = one.select(F.inline(F.array(*[_row(kind, item, **{place.get(kind, "n"): F.col(f"m{i}")})
                                           for i, (kind, item, _) in enumerate(fixed)])))
    c = F.col("cleaned_comment")
    none = F.array().cast("array<string>")
    # An empty pattern splits into characters without a regular expression per character.
    low = F.col("_low")
    lists = {"char": F.array_distinct(F.split(low, "")), "word": tx.words(low, lowered=True), "length": F.array(F.length(c).cast("string"))}
    lists = {kind: F.when(c.isNotNull(), x).otherwise(none) for kind, x in lists.items()}
    if "detected_aspects" in df.columns:
        found = F.coalesce(F.col("detected_aspects"), none)
        if "sentiment" in df.columns:
            found = F.concat(found, F.transform(found, lambda a: F.concat(a, F.lit("_"), F.col("sentiment"))))
        lists["aspect"] = found
    tagged = with_columns_once(df, _low=F.lower(c)).select(F.inline(F.array(*[F.struct(F.lit(kind).alias("kind"), x.alias("items")) for kind, x in lists.items()])))
    values = tagged.select("kind", F.explode("items").alias("item")).where("item is not null and (kind <> 'char' or item <> '')") \
        .groupBy("kind", "item").agg(F.count(F.lit(1)).alias("n"))
    values = written(values, "report-values")
    sketch = values.agg(F.hll_sketch_agg(F.when(F.col("kind") == "word", F.col("item")), HLL_BITS).alias("s"))
    null = lambda to: F.lit(None).cast(to)
    return totals.union(values.select("kind", "item", "n", null("double").alias("x"), null("binary").alias("sketch"))) \
        .union(sketch.select(F.inline(F.array(_row("hll", "words", sketch=F.col("s"))))))


def merge(states: DataFrame) -> DataFrame:
    """States as one: counts and sums add up, extremes and sketches are merged."""
    kind = F.col("kind")
    plain = states.where(~kind.isin("kll", "hll")).groupBy("kind", "item").agg(
        F.when(kind == "min", F.min("n")).when(kind == "max", F.max("n")).otherwise(F.sum("n")).alias("n"),
        F.sum("x").alias("x")).withColumn("sketch", F.lit(None).cast("binary"))

    def sketches(name: str, union) -> DataFrame:
        return states.where((kind == name) & F.col("sketch").isNotNull()).groupBy("kind", "item").agg(union.alias("sketch")) \
            .select("kind", "item", F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("x"), "sketch")

    return plain.union(sketches("kll", F.kll_merge_agg_double("sketch", KLL_K))).union(sketches("hll", F.hll_union_agg("sketch")))


def add(df: DataFrame, table: str, load_id: str, t: Thresholds = DEFAULT_THRESHOLDS) -> bool:
    """Write the state of one load to ``table``, once however often it is repeated; whether it was written now."""
    if loads.is_committed(df.sparkSession, table, load_id):
        return False
    return loads.load(state(df, t), table, load_id, ("kind",))


def states(spark: SparkSession, table: str) -> DataFrame:
    """The committed states, with their load."""
    return loads.read(spark, table, "load_id").select("kind", "item", "n", "x", "sketch", "load_id")


def _of(kind: str, item: str, column: str = "n") -> Column:
    return F.max(F.when((F.col("kind") == kind) & (F.col("item") == item), F.col(column)))


def history(spark: SparkSession, table: str) -> DataFrame:
    """A13 and E6 by load: (load_id, record_count, avg_length, min_length, max_length, empty_comments, quality_score)."""
    fixed = states(spark, table).where(F.col("kind").isin(*FIXED[:4]))
    one = fixed.groupBy("load_id").agg(*[_of("count", c).alias(c) for c in (
        "rows", "texts", "chars", "empty", "very_short", "low_confidence", "with_aspects")],
        _of("min", "length").alias("min_length"), _of("max", "length").alias("max_length"))
    weights = {"empty": -20.0, "very_short": -10.0, "low_confidence": -15.0, "with_aspects": 5.0}               # A11
    shares = [F.coalesce(weight * F.try_divide(c, "rows"), F.lit(0.0)) for c, weight in weights.items()]
    return one.select("load_id", F.col("rows").alias("record_count"), F.try_divide("chars", "texts").cast("double").alias("avg_length"),
                      "min_length", "max_length", F.col("empty").alias("empty_comments"),
                      F.when(F.col("rows") > 0, score_of_shares(shares)).alias("quality_score"))


def report(merged: DataFrame, top_words: int = 10, exact_words: bool = True) -> DataFrame:
    """A21 as (section, metric, value) from a merged state, which is written once."""
    merged = written(merged, "report-state")
    kind, n = F.col("kind"), F.col("n")
    have = {r[0] for r in merged.where(kind == "count").select("item").collect()}     # at most one name per metric
    count = lambda c: F.coalesce(_of("count", c), F.lit(0)).cast("double")
    fixed = merged.where(kind.isin(*FIXED)).agg(
        *[count(c).alias(c) for c in ("texts", "chars", "empty", "very_short", "very_long", "sentences", "sentence_words", "analyzed",
                                      "confidences", "low_confidence", "high_confidence", "with_aspects",
                                      *[f"label_{s}" for s in SENTIMENT_LABELS])],
        _of("min", "length").alias("min"), _of("max", "length").alias("max"), _of("sum", "confidence", "x").alias("confidence"),
        _of("kll", "confidence", "sketch").alias("kll"), _of("hll", "words", "sketch").alias("hll"))
    values = merged.where(kind.isin("char", "length", "aspect") | (F.lit(exact_words) & (kind == "word"))).agg(
        F.percentile(F.when(kind == "length", F.col("item").cast("long")), 0.5, F.when(kind == "length", n).otherwise(0)).alias("median"),
        F.count_if(kind == "char").alias("chars_seen"), F.max((kind == "char") & (F.col("item") == " ")).alias("space"),
        F.count_if(kind == "word").alias("words_seen"),
        F.collect_list(F.when(kind == "aspect", F.struct("item", "n"))).alias("aspects"))
    words = merged.where(kind == "word")
    row = fixed.select("*", F.lit(1).alias("_one")).join(values.select("*", F.lit(1).alias("_one")), "_one") \
        .join(words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("words"), F.lit(1).alias("_one")), "_one")       # one row each
    col = F.col
    total = col("chars") + F.greatest(col("texts") - 1, F.lit(0.0))
    seen = col("chars_seen") + F.when((col("texts") >= 2) & ~F.coalesce(col("space"), F.lit(False)), 1).otherwise(0)
    unique = col("words_seen") if exact_words else F.coalesce(F.hll_sketch_estimate("hll"), F.lit(0))
    zero = F.lit(0.0)
    found = [("text", "total_texts", col("texts")), ("text", "avg_length", F.try_divide("chars", "texts")), ("text", "median_length", col("median")),
             ("text", "min_length", col("min")), ("text", "max_length", col("max")), ("text", "empty_texts", col("empty")),
             ("text", "very_short_texts", col("very_short")), ("text", "very_long_texts", col("very_long")),
             ("readability", "avg_sentence_length", F.coalesce(F.try_divide("sentence_words", "sentences"), zero)),
             ("readability", "avg_sentences_per_text", F.coalesce(F.try_divide("sentences", "texts"), zero)),
             ("language", "char_diversity", F.when(total > 0, seen / total).otherwise(zero)),
             ("language", "unique_words", unique), ("language", "total_words", col("words")),
             ("language", "avg_words_per_text", F.coalesce(F.try_divide("words", "texts"), zero))]
    if "analyzed" in have:
        found += [("sentiment", f"{s}_pct", F.try_divide(col(f"label_{s}") * 100.0, col("analyzed"))) for s in SENTIMENT_LABELS]
        found.append(("sentiment", "total_analyzed", col("analyzed")))
    if "confidences" in have:
        found += [("confidence", "avg_confidence", F.try_divide("confidence", "confidences")),
                  ("confidence", "median_confidence", F.when(col("confidences") > 0, F.kll_sketch_get_quantile_double("kll", F.lit(0.5)))),
                  ("confidence", "low_confidence_count", col("low_confidence")), ("confidence", "high_confidence_count", col("high_confidence"))]
    if "with_aspects" in have:
        found.append(("absa", "total_with_aspects", col("with_aspects")))
    out = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"), v.cast("double").alias("value")) for s, m, v in found])
    aspects = F.transform("aspects", lambda a: F.struct(F.lit("absa").alias("section"), F.concat(F.lit("aspect_"), a["item"]).alias("metric"),
                                                        a["n"].cast("double").alias("value")))
    top = words.orderBy(F.desc("n"), "item").limit(top_words).select(
        F.lit("top_words").alias("section"), col("item").alias("metric"), n.cast("double").alias("value"))
    return row.select(F.inline(F.concat(out, aspects))).union(top)
