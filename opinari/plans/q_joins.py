"""Join queries: J1–J4, J6 (with S2), and the game and source summaries
(A18, A19).

Broadcast hints stand only behind a check of the size: the game dimension up
to a million rows, the hot texts of the score table up to ten thousand. The
rest is joined plainly, and AQE turns a join into a broadcast only after
measuring the small side at run time."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinari.config import FIXTURE_LEXICON as LEX
from opinari.config import FIXTURE_SCORER as SC
from opinari.functions import text as tx
from opinari.operators import filters
from opinari.operators import quality as Q
from opinari.operators import sentiment as sent
from opinari.operators.base import small
from opinari.plans import sqlfrag as S
from opinari.plans.q_quality import round_doubles, scored
from opinari.plans.registry import query
from opinari.sources.tables import comments, games, labelled_text

KEPT = f"WITH {S.COMMENTS_CTE},\n{S.filtered_comments()}"
LABEL = S.lexicon_label("cleaned_comment", SC)
CONF = S.lexicon_conf("cleaned_comment", SC)


def _kept(spark, sf):
    return filters.comment_filter(comments(spark, sf), "value")


def _lexicon(df, text_col):
    return sent.score_lexicon(df, SC, text_col)


@query("comments_with_games", f"""{KEPT},
{S.GAMES_CTE}
SELECT comment_id, kept.game_id, name, rank FROM kept JOIN games ON kept.game_id = games.game_id""")
def comments_with_games(spark, sf):
    """Game attributes onto comments (inner equi-join on game id). The
    games are broadcast if they are few, so comments don't move by hot games."""
    return _kept(spark, sf).join(small(games(spark, sf)), "game_id").select("comment_id", "game_id", "name", "rank")


@query("score_distinct", f"""{KEPT}
SELECT comment_id, md5(cleaned_comment) AS text_key, {LABEL} AS sentiment,
  round({CONF}, 6) AS sentiment_confidence FROM kept""")
def score_distinct(spark, sf):
    """Each distinct text scored once, spread back to all rows."""
    d = sent.score_distinct(_kept(spark, sf), _lexicon, "cleaned_comment")
    return d.select("comment_id", "text_key", "sentiment",
                    tx.round6("sentiment_confidence").alias("sentiment_confidence"))


def _prior_scores(spark, sf):
    """The existing score table: texts of English comments scored earlier."""
    en = _kept(spark, sf).filter(F.col("lang") == "en")
    return sent.incremental_scores(en, spark.createDataFrame([], sent.SCORE_TABLE), _lexicon)


@query("unscored_texts", f"""{KEPT}
SELECT comment_id, md5(cleaned_comment) AS text_key FROM kept
WHERE md5(cleaned_comment) NOT IN (SELECT md5(cleaned_comment) FROM kept WHERE lang = 'en')""")
def unscored_texts(spark, sf):
    """Rows whose text is not in the score table yet."""
    d = sent.unscored(_kept(spark, sf), _prior_scores(spark, sf))
    return d.select("comment_id", "text_key")


@query("scored_texts", f"""{KEPT}
SELECT comment_id, md5(cleaned_comment) AS text_key FROM kept
WHERE md5(cleaned_comment) IN (SELECT md5(cleaned_comment) FROM kept WHERE lang = 'en')""")
def scored_texts(spark, sf):
    """Rows whose score can be reused."""
    d = sent.already_scored(_kept(spark, sf), _prior_scores(spark, sf))
    return d.select("comment_id", "text_key")


@query("scan_labelled", """SELECT d.doc_id, l.quality AS label, d.n_chars, d.lang
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")
def scan_labelled(spark, sf):
    """S2 + J6: typed scan of the labelled text, label = quality."""
    return labelled_text(spark, sf).select("doc_id", "label", "n_chars", "lang")


_RATING = f"""CASE WHEN regexp_matches(trim(rating), {S.lit(tx.NUMBER)})
                THEN TRY_CAST(trim(rating) AS DOUBLE) END"""


@query("game_summary", f"""{KEPT},
{S.GAMES_CTE}
SELECT g.game_id, g.name, g.rank, round(avg({_RATING}), 6) AS rating, count(*) AS comment_count
FROM kept k JOIN games g ON k.game_id = g.game_id
GROUP BY g.game_id, g.name, g.rank ORDER BY g.rank LIMIT 50""")
def game_summary(spark, sf):
    """Rank, mean of the ratings that are numbers, comment count per game; best 50 by rank.
    The aggregate runs before the join, so the join sees one row per game."""
    per_game = (_kept(spark, sf).groupBy("game_id")
                .agg(F.avg(tx.coerce_rating("rating")).alias("rating"),
                     F.count(F.lit(1)).alias("comment_count")))
    out = games(spark, sf).join(per_game, "game_id").orderBy("rank").limit(50)
    return round_doubles(out.select("game_id", "name", "rank", "rating", "comment_count"))


@query("source_summary", f"""WITH {S.COMMENTS_CTE},
{S.filtered_comments()},
scored AS (SELECT *, {S.lexicon_label('cleaned_comment', SC)} AS sentiment,
  {S.lexicon_conf('cleaned_comment', SC)} AS sentiment_confidence,
  {S.extract_aspects('cleaned_comment', LEX)} AS detected_aspects
  FROM kept)
SELECT game_id AS source_id, 'comments' AS source_type,
  strftime(max(created_at), '%Y-%m-%d %H:%M:%S') AS last_updated, count(*) AS record_count,
  round(greatest(0.0, least(100.0, 100.0
    - 20.0 * count_if(length(cleaned_comment) = 0) / count(*)
    - 10.0 * count_if(length(cleaned_comment) < 10) / count(*)
    - 15.0 * count_if(sentiment_confidence < 0.7) / count(*)
    + 5.0 * count_if(len(detected_aspects) > 0) / count(*))), 6) AS data_quality_score
FROM scored GROUP BY game_id""")
def source_summary(spark, sf):
    """Last update, record count and quality score per source."""
    d = scored(spark, sf)
    out = d.groupBy(F.col("game_id").alias("source_id")).agg(
        F.date_format(F.max("created_at"), "yyyy-MM-dd HH:mm:ss").alias("last_updated"),
        F.count(F.lit(1)).alias("record_count"),
        Q.quality_score_expr(d).alias("data_quality_score"))
    return round_doubles(out.select("source_id", F.lit("comments").alias("source_type"), "last_updated",
                                    "record_count", "data_quality_score"))
