"""Quality and report queries: A1–A7, A11–A16, A20, A21.

They run over the scored comment table: cleaned comments with lexicon
sentiment and detected aspects (rows without aspects kept)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinari.config import FIXTURE_LEXICON as LEX
from opinari.config import FIXTURE_SCORER as SC
from opinari.config import QUALITY_RULES
from opinari.functions import text as tx
from opinari.operators import filters, language
from opinari.operators import quality as Q
from opinari.operators import report_state
from opinari.operators.base import written
from opinari.plans import jobs
from opinari.plans import sqlfrag as S
from opinari.plans.q_text import CLEAN_JOB_CTES, CLEAN_JOB_SELECT, _SENT_SQL, detector
from opinari.plans.registry import ORACLE, query
from opinari.session import scratch_path
from opinari.sources.tables import comments

SCORED = f"""WITH {S.COMMENTS_CTE},
{S.filtered_comments()},
scored AS (SELECT *, {S.lexicon_label('cleaned_comment', SC)} AS sentiment,
  {S.lexicon_conf('cleaned_comment', SC)} AS sentiment_confidence,
  {S.extract_aspects('cleaned_comment', LEX)} AS detected_aspects FROM kept),
t AS (SELECT cleaned_comment AS c FROM scored WHERE cleaned_comment IS NOT NULL)"""


def round_doubles(df: DataFrame) -> DataFrame:
    """Round every double column to 6 digits (sums depend on order)."""
    return df.select(*[F.round(F.col(f.name), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f.name) for f in df.schema.fields])


def scored(spark, sf) -> DataFrame:
    kept = filters.comment_filter(comments(spark, sf), "value")
    return jobs.batch_inference(kept, "both")


@query("text_length_profile", f"""{SCORED}
SELECT count(*) AS total_texts, round(avg(length(c)), 6) AS avg_length,
  round(median(length(c))::DOUBLE, 6) AS median_length, min(length(c)) AS min_length,
  max(length(c)) AS max_length, count_if(length(c) = 0) AS empty_texts,
  count_if(length(c) < 10) AS very_short_texts, count_if(length(c) > 1000) AS very_long_texts FROM t""")
def text_length_profile(spark, sf):
    return round_doubles(Q.text_length_profile(scored(spark, sf)))


@query("readability", f"""{SCORED},
x AS (SELECT {_SENT_SQL.replace('text', 'c')} AS w FROM t),
a AS (SELECT count(*) AS n, sum(len(w)) AS s, sum(coalesce(list_sum(w), 0)) AS wd FROM x)
SELECT round(coalesce(wd / nullif(s, 0), 0.0), 6) AS avg_sentence_length,
  round(CASE WHEN s > 0 THEN s / n ELSE 0.0 END, 6) AS avg_sentences_per_text FROM a""")
def readability(spark, sf):
    return round_doubles(Q.readability(scored(spark, sf)))


@query("char_diversity", f"""{SCORED},
ch AS (SELECT DISTINCT unnest(regexp_extract_all(lower(c), '(?s)(.)', 1)) AS ch FROM t),
d AS (SELECT count(*) AS dc, max(CASE WHEN ch = ' ' THEN 1 ELSE 0 END) AS hs FROM ch),
s AS (SELECT count(*) AS n, sum(length(c)) AS chars FROM t),
v AS (SELECT dc + CASE WHEN n >= 2 AND coalesce(hs, 0) = 0 THEN 1 ELSE 0 END AS u,
             coalesce(chars, 0) + greatest(n - 1, 0) AS tot FROM d, s)
SELECT CAST(u AS BIGINT) AS unique_chars, CAST(tot AS BIGINT) AS total_chars,
  round(CASE WHEN tot > 0 THEN u / tot ELSE 0.0 END, 6) AS char_diversity FROM v""")
def char_diversity(spark, sf):
    return round_doubles(Q.char_diversity(scored(spark, sf)))


_WORDS = f"w AS (SELECT unnest({S.words('c')}) AS word FROM t)"


@query("vocabulary", f"""{SCORED},
{_WORDS},
n AS (SELECT count(*) AS n_texts FROM t),
a AS (SELECT count(DISTINCT word) AS unique_words, count(*) AS total_words FROM w)
SELECT unique_words, total_words,
  round(CASE WHEN n_texts > 0 THEN total_words / n_texts ELSE 0.0 END, 6) AS avg_words_per_text FROM a, n""")
def vocabulary(spark, sf):
    return round_doubles(Q.vocabulary(scored(spark, sf)))


@query("top_words", f"""{SCORED},
{_WORDS}
SELECT word, count(*) AS count FROM w GROUP BY word ORDER BY count DESC, word LIMIT 10""")
def top_words(spark, sf):
    return Q.top_words(scored(spark, sf))


@query("sentiment_distribution", f"""{SCORED},
a AS (SELECT count(*) AS n, count_if(sentiment = 'positive') AS p, count_if(sentiment = 'negative') AS ng,
             count_if(sentiment = 'unknown') AS u FROM scored)
SELECT * FROM (
  SELECT 'positive' AS sentiment, p AS count, round(p * 100.0 / n, 6) AS percentage FROM a UNION ALL
  SELECT 'negative', ng, round(ng * 100.0 / n, 6) FROM a UNION ALL
  SELECT 'unknown', u, round(u * 100.0 / n, 6) FROM a)""")
def sentiment_distribution(spark, sf):
    return round_doubles(Q.sentiment_distribution(scored(spark, sf)))


@query("confidence_profile", f"""{SCORED}
SELECT round(avg(sentiment_confidence), 6) AS avg_confidence,
  round(median(sentiment_confidence), 6) AS median_confidence,
  count_if(sentiment_confidence < 0.7) AS low_confidence_count,
  count_if(sentiment_confidence > 0.9) AS high_confidence_count
FROM scored WHERE sentiment_confidence IS NOT NULL""")
def confidence_profile(spark, sf):
    return round_doubles(Q.confidence_profile(scored(spark, sf)))


_SCORE_SQL = """greatest(0.0, least(100.0, 100.0
  - 20.0 * count_if(length(cleaned_comment) = 0) / count(*)
  - 10.0 * count_if(length(cleaned_comment) < 10) / count(*)
  - 15.0 * count_if(sentiment_confidence < 0.7) / count(*)
  + 5.0 * count_if(len(detected_aspects) > 0) / count(*)))"""


@query("quality_score", f"""{SCORED}
SELECT round({_SCORE_SQL}, 6) AS quality_score FROM scored""")
def quality_score(spark, sf):
    return round_doubles(Q.quality_score(scored(spark, sf)))


_EXTRACTED = f"""ex AS (SELECT game_id, username, rating, value,
  nullif({S.clean_text_tags('value')}, '') AS cleaned_comment FROM comments)"""


def extracted(spark, sf) -> DataFrame:
    """The extractor's output table: light-cleaned text."""
    return jobs.light_clean(comments(spark, sf)).select("game_id", "username", "rating", "value", "cleaned_comment")


@query("validate_extraction", f"""WITH {S.COMMENTS_CTE},
{_EXTRACTED},
a AS (SELECT count(*) AS total_comments, count(DISTINCT game_id) AS unique_games,
  count_if(cleaned_comment IS NULL) AS empty_comments, avg(length(cleaned_comment)) AS avg_comment_length FROM ex)
SELECT total_comments, unique_games, empty_comments, round(avg_comment_length, 6) AS avg_comment_length,
  true AS has_required_columns,
  array_to_string(list_filter([CASE WHEN total_comments < 100 THEN 'too_few_rows' END,
    CASE WHEN empty_comments > total_comments * 0.5 THEN 'too_many_empty' END],
    lambda x: x IS NOT NULL), '|') AS errors,
  NOT (total_comments < 100 OR empty_comments > total_comments * 0.5) AS is_valid FROM a""")
def validate_extraction(spark, sf):
    v = Q.validate_extraction(extracted(spark, sf))
    return round_doubles(v.withColumn("errors", F.array_join("errors", "|")))


@query("validate_cleaned", f"""{CLEAN_JOB_CTES},
cj AS ({CLEAN_JOB_SELECT}),
qa AS (SELECT count(*) AS total_comments, avg(length(cleaned_comment)) AS avg_comment_length,
  min(length(cleaned_comment)) AS min_comment_length, max(length(cleaned_comment)) AS max_comment_length,
  count_if(length({S.rx('cleaned_comment', rf'^[{tx.WS}]+|[{tx.WS}]+$')}) = 0) AS empty_comments,
  count(DISTINCT game_id) AS unique_games FROM cj)
SELECT total_comments, round(avg_comment_length, 6) AS avg_comment_length, min_comment_length,
  max_comment_length, empty_comments, unique_games, true AS has_metadata,
  array_to_string(list_filter([CASE WHEN empty_comments > 0 THEN 'empty_comments' END,
    CASE WHEN avg_comment_length < 20 THEN 'short_mean_length' END],
    lambda x: x IS NOT NULL), '|') AS warnings, true AS is_valid FROM qa""")
def validate_cleaned(spark, sf):
    v = Q.validate_cleaned(jobs.clean_job(comments(spark, sf), detector(spark, sf)))
    return round_doubles(v.withColumn("warnings", F.array_join("warnings", "|")))


@query("cleaning_report", f"""{CLEAN_JOB_CTES},
cj AS ({CLEAN_JOB_SELECT}),
{_EXTRACTED},
qa AS (SELECT count(*) AS original_count, avg(length(cleaned_comment)) AS avg_length_before FROM ex),
qb AS (SELECT count(*) AS cleaned_count, avg(length(cleaned_comment)) AS avg_length_after FROM cj)
SELECT original_count, cleaned_count, original_count - cleaned_count AS removed_count,
  round((original_count - cleaned_count) / original_count, 6) AS removal_rate,
  round(avg_length_before, 6) AS avg_length_before, round(avg_length_after, 6) AS avg_length_after FROM qa, qb""")
def cleaning_report(spark, sf):
    return round_doubles(Q.cleaning_report(extracted(spark, sf), jobs.clean_job(comments(spark, sf), detector(spark, sf))))


_PROFILE_COLS = [("comment_id", "bigint"), ("game_id", "string"), ("username", "string"),
                 ("rating", "string"), ("value", "string"), ("lang", "string"),
                 ("created_at", "timestamp_ntz")]


@query("table_profile", f"""WITH {S.COMMENTS_CTE},
n AS (SELECT count(*) AS row_count,
  {', '.join(f'count_if({c} IS NULL) AS n_{c}' for c, _ in _PROFILE_COLS)} FROM comments),
d AS (SELECT coalesce(sum(k - 1), 0) AS duplicate_rows FROM
      (SELECT count(*) AS k FROM comments GROUP BY ALL_COLS)),
l AS ({' UNION ALL '.join(f"SELECT '{c}' AS column_name, '{t}' AS data_type, n_{c} AS null_count FROM n"
                          for c, _t in _PROFILE_COLS for t in [_t])})
SELECT row_count, {len(_PROFILE_COLS)} AS column_count, CAST(duplicate_rows AS BIGINT) AS duplicate_rows,
  column_name, data_type, null_count, round(null_count * 100.0 / row_count, 6) AS null_percentage
FROM l, n, d""".replace("ALL_COLS", ", ".join(c for c, _ in _PROFILE_COLS)))
def table_profile(spark, sf):
    return round_doubles(Q.table_profile(comments(spark, sf)))


@query("language_distribution", f"""{SCORED}
SELECT CASE WHEN {S.is_english('cleaned_comment')} THEN 'en' ELSE 'unknown' END AS detected_language,
  count(*) AS count FROM scored GROUP BY 1""")
def language_distribution(spark, sf):
    d = language.english_fallback(scored(spark, sf), "cleaned_comment")
    return Q.language_distribution(d)


def _rules_sql() -> str:
    return ", ".join(f"('{r.metric_name}', {r.threshold}, {str(r.higher_is_better).lower()}, {r.warn_margin})"
                     for r in QUALITY_RULES)


@query("quality_metric_rows", f"""{SCORED},
a AS (SELECT avg(length(cleaned_comment)) AS avg_length,
  count_if(length(cleaned_comment) = 0) / count(*) AS empty_ratio,
  count_if(length(cleaned_comment) < 10) / count(*) AS short_ratio,
  avg(sentiment_confidence) AS avg_confidence,
  count_if(sentiment_confidence < 0.7) / count(*) AS low_confidence_ratio,
  {_SCORE_SQL} AS quality_score FROM scored),
l AS (SELECT 'avg_length' AS metric_name, avg_length::DOUBLE AS value FROM a UNION ALL
      SELECT 'empty_ratio', empty_ratio FROM a UNION ALL SELECT 'short_ratio', short_ratio FROM a UNION ALL
      SELECT 'avg_confidence', avg_confidence FROM a UNION ALL
      SELECT 'low_confidence_ratio', low_confidence_ratio FROM a UNION ALL
      SELECT 'quality_score', quality_score FROM a),
r(metric_name, threshold, hib, margin) AS (VALUES {_rules_sql()})
SELECT l.metric_name, round(value, 6) AS value, threshold::DOUBLE AS threshold,
  CASE WHEN threshold IS NULL OR value IS NULL THEN 'unknown'
       WHEN hib THEN CASE WHEN value >= threshold THEN 'good' WHEN value >= threshold - margin THEN 'warning' ELSE 'error' END
       ELSE CASE WHEN value <= threshold THEN 'good' WHEN value <= threshold + margin THEN 'warning' ELSE 'error' END
  END AS status
FROM l LEFT JOIN r USING (metric_name)""")
def quality_metric_rows(spark, sf):
    return round_doubles(Q.quality_metric_rows(spark, scored(spark, sf)))


@query("quality_report", f"""{SCORED},
x AS (SELECT {_SENT_SQL.replace('text', 'c')} AS w FROM t),
ra AS (SELECT count(*) AS n, sum(len(w)) AS s, sum(coalesce(list_sum(w), 0)) AS wd FROM x),
ch AS (SELECT DISTINCT unnest(regexp_extract_all(lower(c), '(?s)(.)', 1)) AS ch FROM t),
cd AS (SELECT count(*) AS dc, max(CASE WHEN ch = ' ' THEN 1 ELSE 0 END) AS hs FROM ch),
cs AS (SELECT count(*) AS n, sum(length(c)) AS chars FROM t),
cv AS (SELECT dc + CASE WHEN n >= 2 AND coalesce(hs, 0) = 0 THEN 1 ELSE 0 END AS u,
              coalesce(chars, 0) + greatest(n - 1, 0) AS tot FROM cd, cs),
{_WORDS},
wa AS (SELECT count(DISTINCT word) AS uw, count(*) AS tw FROM w),
sa AS (SELECT count(*) AS n, count_if(sentiment = 'positive') AS p, count_if(sentiment = 'negative') AS ng,
              count_if(sentiment = 'unknown') AS u FROM scored),
withasp AS (SELECT * FROM scored WHERE len(detected_aspects) > 0),
rows AS (
  SELECT 'text' AS section, 'total_texts' AS metric, count(*)::DOUBLE AS value FROM t UNION ALL
  SELECT 'text', 'avg_length', avg(length(c)) FROM t UNION ALL
  SELECT 'text', 'median_length', median(length(c))::DOUBLE FROM t UNION ALL
  SELECT 'text', 'min_length', min(length(c))::DOUBLE FROM t UNION ALL
  SELECT 'text', 'max_length', max(length(c))::DOUBLE FROM t UNION ALL
  SELECT 'text', 'empty_texts', count_if(length(c) = 0)::DOUBLE FROM t UNION ALL
  SELECT 'text', 'very_short_texts', count_if(length(c) < 10)::DOUBLE FROM t UNION ALL
  SELECT 'text', 'very_long_texts', count_if(length(c) > 1000)::DOUBLE FROM t UNION ALL
  SELECT 'readability', 'avg_sentence_length', coalesce(wd / nullif(s, 0), 0.0) FROM ra UNION ALL
  SELECT 'readability', 'avg_sentences_per_text', CASE WHEN s > 0 THEN s / n ELSE 0.0 END FROM ra UNION ALL
  SELECT 'language', 'char_diversity', CASE WHEN tot > 0 THEN u / tot ELSE 0.0 END FROM cv UNION ALL
  SELECT 'language', 'unique_words', uw::DOUBLE FROM wa UNION ALL
  SELECT 'language', 'total_words', tw::DOUBLE FROM wa UNION ALL
  SELECT 'language', 'avg_words_per_text', CASE WHEN (SELECT count(*) FROM t) > 0
         THEN tw / (SELECT count(*) FROM t) ELSE 0.0 END FROM wa UNION ALL
  SELECT 'sentiment', 'positive_pct', p * 100.0 / n FROM sa UNION ALL
  SELECT 'sentiment', 'negative_pct', ng * 100.0 / n FROM sa UNION ALL
  SELECT 'sentiment', 'unknown_pct', u * 100.0 / n FROM sa UNION ALL
  SELECT 'sentiment', 'total_analyzed', n::DOUBLE FROM sa UNION ALL
  SELECT 'confidence', 'avg_confidence', avg(sentiment_confidence) FROM scored WHERE sentiment_confidence IS NOT NULL UNION ALL
  SELECT 'confidence', 'median_confidence', median(sentiment_confidence) FROM scored WHERE sentiment_confidence IS NOT NULL UNION ALL
  SELECT 'confidence', 'low_confidence_count', count_if(sentiment_confidence < 0.7)::DOUBLE FROM scored WHERE sentiment_confidence IS NOT NULL UNION ALL
  SELECT 'confidence', 'high_confidence_count', count_if(sentiment_confidence > 0.9)::DOUBLE FROM scored WHERE sentiment_confidence IS NOT NULL UNION ALL
  SELECT 'absa', 'total_with_aspects', count(*)::DOUBLE FROM withasp UNION ALL
  SELECT 'absa', 'aspect_' || a, count(*)::DOUBLE FROM (SELECT unnest(detected_aspects) AS a FROM withasp) GROUP BY a UNION ALL
  SELECT 'absa', 'aspect_' || a || '_' || sentiment, count(*)::DOUBLE
  FROM (SELECT unnest(detected_aspects) AS a, sentiment FROM withasp) GROUP BY a, sentiment UNION ALL
  SELECT 'top_words', word, n FROM (SELECT word, count(*)::DOUBLE AS n FROM w GROUP BY word ORDER BY n DESC, word LIMIT 10))
SELECT section, metric, round(value, 6) AS value FROM rows""")
def quality_report(spark, sf):
    return round_doubles(Q.quality_report(scored(spark, sf)))


@query("quality_report_by_load", f"SELECT * FROM ({ORACLE['quality_report']}) WHERE metric <> 'median_confidence'")
def quality_report_by_load(spark, sf):
    """A21 from the states of three loads, which are all comments dealt by a hash; without the one sketched metric."""
    rows = written(scored(spark, sf).select("comment_id", "cleaned_comment", "sentiment", "sentiment_confidence", "detected_aspects"), "scored")
    table = scratch_path(spark, "report-states")
    part = F.pmod(F.xxhash64("comment_id"), F.lit(3))
    for i in range(3):
        report_state.add(rows.where(part == i).drop("comment_id"), table, f"load-{i}")
    report = report_state.report(report_state.merge(report_state.states(spark, table)))
    return round_doubles(report.where("metric <> 'median_confidence'"))
