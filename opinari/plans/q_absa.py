"""Aspect and sentiment queries: T13–T15, M6–M8, M11, J5, A8–A10, P11–P13, U3.

Array results are returned joined by ``|`` and maps in long format, so the
oracle comparison sees plain strings on both sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinari.config import FIXTURE_LEXICON as LEX
from opinari.config import FIXTURE_SCORER as SC
from opinari.functions import aspects as fa
from opinari.functions import sentiment as fs
from opinari.functions import text as tx
from opinari.operators import aspects as A
from opinari.operators import filters
from opinari.operators.sentiment import score_lexicon
from opinari.plans import jobs
from opinari.plans import sqlfrag as S
from opinari.operators.keywords import gram_hits
from opinari.plans.registry import query
from opinari.session import table_path
from opinari.sources.tables import comments, read_table

WITH = f"WITH {S.COMMENTS_CTE},\n{S.filtered_comments()}"
ASPECTS = S.extract_aspects("cleaned_comment", LEX)
LABEL = S.lexicon_label("cleaned_comment", SC)
CONF = S.lexicon_conf("cleaned_comment", SC)
REQUESTED = ("plain_a", "ctx_lead")


def _kept(spark, sf):
    return filters.comment_filter(comments(spark, sf), "value")


@query("aspect_extract", f"""{WITH}
SELECT comment_id, array_to_string(a, '|') AS detected_aspects
FROM (SELECT comment_id, {ASPECTS} AS a FROM kept) WHERE len(a) > 0""")
def aspect_extract(spark, sf):
    d = A.keep_with_aspects(A.add_aspects(_kept(spark, sf), LEX))
    return d.select("comment_id", F.array_join("detected_aspects", "|").alias("detected_aspects"))


@query("aspect_extract_plain", f"""{WITH}
SELECT comment_id, array_to_string(a, '|') AS detected_aspects
FROM (SELECT comment_id, {S.extract_aspects('cleaned_comment', LEX, False)} AS a FROM kept)
WHERE len(a) > 0""")
def aspect_extract_plain(spark, sf):
    """T13 notebook form: keywords only, no context rules."""
    d = A.keep_with_aspects(A.add_aspects(_kept(spark, sf), LEX, use_context=False))
    return d.select("comment_id", F.array_join("detected_aspects", "|").alias("detected_aspects"))


@query("sentiment_lexicon", f"""{WITH}
SELECT comment_id, {LABEL} AS sentiment, round({CONF}, 6) AS sentiment_confidence FROM kept""")
def sentiment_lexicon(spark, sf):
    d = score_lexicon(_kept(spark, sf), SC)
    return d.select("comment_id", "sentiment", tx.round6("sentiment_confidence").alias("sentiment_confidence"))


@query("sentiment_unknown", f"""WITH {S.COMMENTS_CTE},
c AS (SELECT comment_id, {S.clean_text('value')} AS cleaned_comment FROM comments)
SELECT comment_id, {LABEL} AS sentiment, round({CONF}, 6) AS sentiment_confidence FROM c""")
def sentiment_unknown(spark, sf):
    """M7: every comment is scored; null or blank text → ('unknown', 0.0)."""
    d = comments(spark, sf).select("comment_id", tx.clean_text("value").alias("cleaned_comment"))
    d = score_lexicon(d, SC)
    return d.select("comment_id", "sentiment", tx.round6("sentiment_confidence").alias("sentiment_confidence"))


_LOGIT_NEG_SQL = "n_chars / 1000.0"
_LOGIT_POS_SQL = "len(string_split(text, ' ')) / 150.0"
_MARGIN = f"(({_LOGIT_POS_SQL}) - ({_LOGIT_NEG_SQL}))"
_P = f"(1.0 / (1.0 + exp(-{_MARGIN})))"


@query("score_to_label", f"""
SELECT doc_id, CASE WHEN {_MARGIN} > 0 THEN 'positive' ELSE 'negative' END AS sentiment,
  round(greatest({_P}, 1.0 - {_P}), 6) AS sentiment_confidence,
  round(1.0 - {_P}, 6) AS p_negative, round({_P}, 6) AS p_positive
FROM documents""")
def score_to_label(spark, sf):
    """T14 on two class scores derived from each document (length-based)."""
    d = read_table(spark, sf, "documents")
    s = fs.scores_to_label(F.col("n_chars") / 1000.0, F.size(F.split("text", " ")) / 150.0)
    return d.select("doc_id", s.alias("s")).select(
        "doc_id", "s.sentiment", tx.round6("s.sentiment_confidence").alias("sentiment_confidence"),
        tx.round6("s.p_negative").alias("p_negative"), tx.round6("s.p_positive").alias("p_positive"))


@query("aspect_sentiment", f"""{WITH},
s AS (SELECT comment_id, {ASPECTS} AS a, {LABEL} AS sentiment FROM kept)
SELECT comment_id, unnest(a) AS aspect, sentiment FROM s WHERE len(a) > 0""")
def aspect_sentiment(spark, sf):
    d = jobs.absa_job(comments(spark, sf))
    return d.select("comment_id", F.explode("aspect_sentiments").alias("aspect", "sentiment"))


@query("absa_job", f"""{WITH}
SELECT comment_id, game_id, array_to_string(a, '|') AS detected_aspects, sentiment,
       sentiment_confidence
FROM (SELECT comment_id, game_id, {ASPECTS} AS a, {LABEL} AS sentiment,
             round({CONF}, 6) AS sentiment_confidence FROM kept)
WHERE len(a) > 0""")
def absa_job(spark, sf):
    """M8 end to end over the comment table."""
    d = jobs.absa_job(comments(spark, sf))
    return d.select("comment_id", "game_id",
                    F.array_join("detected_aspects", "|").alias("detected_aspects"),
                    "sentiment", tx.round6("sentiment_confidence").alias("sentiment_confidence"))


_EXPLODED = f"""{WITH},
s AS (SELECT comment_id, {ASPECTS} AS a, {LABEL} AS sentiment FROM kept),
e AS (SELECT unnest(a) AS aspect, sentiment FROM s)"""


@query("aspect_counts", f"""{_EXPLODED}
SELECT aspect, count(*) AS comment_count FROM e GROUP BY aspect""")
def aspect_counts(spark, sf):
    return A.aspect_counts(jobs.absa_job(comments(spark, sf)))


@query("aspect_sentiment_counts", f"""{_EXPLODED}
SELECT aspect, count_if(sentiment = 'positive') AS positive,
       count_if(sentiment = 'negative') AS negative, count_if(sentiment = 'unknown') AS unknown
FROM e GROUP BY aspect""")
def aspect_sentiment_counts(spark, sf):
    return A.aspect_sentiment_counts(jobs.absa_job(comments(spark, sf)))


@query("aspect_summary", f"""{_EXPLODED}
SELECT aspect, count(*) AS total_comments,
  count_if(sentiment = 'positive') AS positive_count,
  count_if(sentiment = 'negative') AS negative_count,
  count_if(sentiment = 'unknown') AS unknown_count,
  round(count_if(sentiment = 'positive') * 100.0 / count(*), 6) AS positive_percentage,
  round(count_if(sentiment = 'negative') * 100.0 / count(*), 6) AS negative_percentage
FROM e GROUP BY aspect ORDER BY {S.position('aspect', LEX.names)}""")
def aspect_summary(spark, sf):
    """A10, the main report (also ``entry()``)."""
    s = jobs.aspect_summary_job(comments(spark, sf))
    return s.select("aspect", "total_comments", "positive_count", "negative_count", "unknown_count",
                    tx.round6("positive_percentage").alias("positive_percentage"),
                    tx.round6("negative_percentage").alias("negative_percentage"))


def _lexicon_values_sql() -> str:
    rows, seen = [], set()
    for a in LEX.aspects:
        for k in a.keywords:
            if (a.name, k) not in seen:
                seen.add((a.name, k))
                rows.append(f"({S.lit(a.name)}, {S.lit(k)})")
    return ", ".join(rows)


@query("keyword_hits", f"""{WITH},
lex(aspect, keyword) AS (VALUES {_lexicon_values_sql()})
SELECT comment_id, aspect, keyword FROM kept JOIN lex ON contains(lower(cleaned_comment), keyword)""")
def keyword_hits(spark, sf):
    """J5 with the lexicon as a table."""
    return A.keyword_hits(_kept(spark, sf), A.lexicon_table(spark, LEX), "comment_id")


@query("keyword_join", f"""{WITH},
bench AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS keyword FROM benchmark),
lex AS (SELECT DISTINCT substr(keyword, 1, 1) AS aspect, keyword FROM bench WHERE keyword IS NOT NULL)
SELECT comment_id, aspect, keyword FROM kept JOIN lex ON contains(lower(cleaned_comment), keyword)""")
def keyword_join(spark, sf):
    """J5 with a keyword table that grows with the data: every word of the benchmark texts, by first letter."""
    words = spark.read.parquet(table_path(sf, "benchmark")).select(
        F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))).alias("keyword"))
    return gram_hits(_kept(spark, sf), words.select(F.substr("keyword", F.lit(1), F.lit(1)).alias("aspect"), "keyword"),
                     "comment_id", "cleaned_comment")


@query("aspect_subset", f"""{WITH}
SELECT comment_id, array_to_string(list_sort(list_intersect(a, [{', '.join(S.lit(r) for r in REQUESTED)}])), '|') AS aspects
FROM (SELECT comment_id, {ASPECTS} AS a FROM kept) WHERE len(a) > 0""")
def aspect_subset(spark, sf):
    """Aspects asked for ∩ aspects found (sorted)."""
    d = A.keep_with_aspects(A.add_aspects(_kept(spark, sf), LEX))
    req = F.array(*[F.lit(r) for r in REQUESTED])
    return d.select("comment_id",
                    F.array_join(F.array_sort(F.array_intersect("detected_aspects", req)), "|").alias("aspects"))


@query("batch_inference_both", f"""{WITH}
SELECT comment_id, {LABEL} AS sentiment, round({CONF}, 6) AS sentiment_confidence,
  array_to_string({ASPECTS}, '|') AS detected_aspects, 'lexicon-1' AS model_version FROM kept""")
def batch_inference_both(spark, sf):
    """M11 with analysis type ``both``."""
    d = jobs.batch_inference(_kept(spark, sf), "both")
    return d.select("comment_id", "sentiment", tx.round6("sentiment_confidence").alias("sentiment_confidence"),
                    F.array_join("detected_aspects", "|").alias("detected_aspects"), "model_version")


_REQ_ASPECTS_SQL = (f"CASE role WHEN 'user' THEN {S.extract_aspects('text', LEX)} "
                    f"WHEN 'assistant' THEN NULL ELSE ['plain_a', 'luck'] END")
_REQ_TYPE_SQL = "CASE role WHEN 'user' THEN 'absa' WHEN 'assistant' THEN 'sentiment' ELSE 'summary' END"
_KNOWN = "[" + ", ".join(S.lit(n) for n in LEX.names) + "]"


@query("validate_aspects", f"""
WITH r AS (SELECT conv_id, turn, {_REQ_ASPECTS_SQL} AS req, {_REQ_TYPE_SQL} AS analysis_type
           FROM conversations),
f AS (SELECT conv_id, turn, list_filter([
  CASE WHEN req IS NOT NULL AND len(req) = 0 THEN 'empty_aspects' END,
  CASE WHEN req IS NOT NULL AND len(list_filter(req, lambda x: NOT list_contains({_KNOWN}, x))) > 0
       THEN 'unknown_aspect' END,
  CASE WHEN NOT coalesce(analysis_type IN ('sentiment', 'absa', 'both'), false)
       THEN 'unknown_analysis_type' END], lambda x: x IS NOT NULL) AS fr FROM r)
SELECT conv_id, turn, array_to_string(fr, '|') AS failed_rules, len(fr) = 0 AS is_valid FROM f""")
def validate_aspects(spark, sf):
    """P12 over requests built from conversation turns: user turns ask for the
    aspects their text mentions, assistant turns give none, other roles ask for
    an unknown aspect with an unknown analysis type."""
    c = read_table(spark, sf, "conversations")
    req = (F.when(F.col("role") == "user", fa.extract_aspects(F.col("text"), LEX))
           .when(F.col("role") == "assistant", F.lit(None).cast("array<string>"))
           .otherwise(F.array(F.lit("plain_a"), F.lit("luck"))))
    typ = (F.when(F.col("role") == "user", "absa").when(F.col("role") == "assistant", "sentiment")
           .otherwise("summary"))
    r = c.select("conv_id", "turn", req.alias("req"), typ.alias("analysis_type"))
    v = filters.aspect_request_failures(r, "req", "analysis_type", LEX)
    return v.select("conv_id", "turn", F.array_join("failed_rules", "|").alias("failed_rules"), "is_valid")


@query("validate_requests", f"""
WITH s AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id),
f AS (SELECT c.conv_id, turn, list_filter([
  CASE WHEN text IS NULL OR length({S.rx('text', tx.WS_RUN)}) < 1 THEN 'blank_comment' END,
  CASE WHEN length(text) > 5000 THEN 'comment_too_long' END,
  CASE WHEN n > 1000 THEN 'too_many_comments' END], lambda x: x IS NOT NULL) AS fr
  FROM conversations c LEFT JOIN s ON c.conv_id = s.conv_id)
SELECT conv_id, turn, array_to_string(fr, '|') AS failed_rules, len(fr) = 0 AS is_valid FROM f""")
def validate_requests(spark, sf):
    """Each conversation is one request, each turn one comment."""
    c = read_table(spark, sf, "conversations").select("conv_id", "turn", "text")
    v = filters.request_rule_failures(c, "text", "conv_id")
    return v.select("conv_id", "turn", F.array_join("failed_rules", "|").alias("failed_rules"), "is_valid")
