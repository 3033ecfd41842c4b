"""Text-function and filter queries: T1–T12, T16, P2–P10, P14, W1–W3, U1, U2,
and the cleaning job."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinari.config import FIXTURE_LEXICON, NA_TOKENS, NOUN_SUFFIX_RULES
from opinari.functions.aspects import extract_aspects
from opinari.functions import text as tx
from opinari.operators import dedup, filters, language, lemma
from opinari.plans import jobs
from opinari.plans import sqlfrag as S
from opinari.plans.registry import query
from opinari.sources.tables import comments, read_table

C = f"WITH {S.COMMENTS_CTE}"
KEPT = f"WITH {S.COMMENTS_CTE},\n{S.filtered_comments()}"


def _strip_sql(e: str) -> str:
    return S.rx(e, rf"^[{tx.WS}]+|[{tx.WS}]+$")


def _kept(spark, sf):
    return filters.comment_filter(comments(spark, sf), "value")


# --- T1–T4 -----------------------------------------------------------------

@query("clean_text", f"{C}\nSELECT comment_id, {S.clean_text('value')} AS cleaned FROM comments")
def clean_text(spark, sf):
    return comments(spark, sf).select("comment_id", tx.clean_text("value").alias("cleaned"))


@query("clean_text_basic", f"{C}\nSELECT comment_id, {S.clean_text('value', False)} AS cleaned FROM comments")
def clean_text_basic(spark, sf):
    return comments(spark, sf).select("comment_id", tx.clean_text("value", False).alias("cleaned"))


@query("clean_text_tags", f"{C}\nSELECT comment_id, {S.clean_text_tags('value')} AS cleaned FROM comments")
def clean_text_tags(spark, sf):
    return comments(spark, sf).select("comment_id", tx.clean_text_tags("value").alias("cleaned"))


@query("strip_emails", f"{C}\nSELECT comment_id, {S.rx('value', tx.EMAIL)} AS stripped FROM comments")
def strip_emails(spark, sf):
    return comments(spark, sf).select("comment_id", tx.strip_emails("value").alias("stripped"))


@query("strip_urls", f"{C}\nSELECT comment_id, {S.rx('value', tx.URL)} AS stripped FROM comments")
def strip_urls(spark, sf):
    return comments(spark, sf).select("comment_id", tx.strip_urls("value").alias("stripped"))


@query("strip_punctuation", f"""{C}
SELECT comment_id, {S.rx('value', tx.NOT_KEPT_PUNCT)} AS kept_common,
       {S.rx('value', tx.ASCII_PUNCT)} AS removed_all FROM comments""")
def strip_punctuation(spark, sf):
    c = comments(spark, sf)
    return c.select("comment_id", tx.strip_punctuation("value").alias("kept_common"),
                    tx.strip_punctuation("value", remove_all=True).alias("removed_all"))


def _lemma_sql(tokens_cte: str, id_col: str, toks: str, out: str) -> str:
    """Oracle for the lemma job over ``tokens_cte(id_col, toks)``."""
    cands = ["SELECT token, 0 AS idx, token AS cand FROM v"]
    for i, (suf, rep) in enumerate(NOUN_SUFFIX_RULES, start=1):
        cands.append(f"SELECT token, {i}, left(token, length(token) - {len(suf)}) || {S.lit(rep)} "
                     f"FROM v WHERE suffix(token, {S.lit(suf)})")
    return f"""p AS (SELECT {id_col}, unnest({toks}) AS token, generate_subscripts({toks}, 1) AS pos
             FROM {tokens_cte}),
v AS (SELECT DISTINCT token FROM p),
c AS ({' UNION ALL '.join(cands)}),
k AS (SELECT * FROM c WHERE length(cand) > 0 AND cand IN (SELECT token FROM v)),
m AS (SELECT token, arg_min(cand, length(cand) * 100 + idx) AS lemma FROM k GROUP BY token),
l AS (SELECT {id_col}, pos, coalesce(m.lemma, p.token) AS lemma FROM p LEFT JOIN m USING (token)),
a AS (SELECT {id_col}, string_agg(lemma, ' ' ORDER BY pos) AS s FROM l GROUP BY {id_col}),
{out} AS (SELECT t.{id_col}, coalesce(a.s, '') AS lemmas FROM {tokens_cte} t LEFT JOIN a USING ({id_col}))"""


@query("deep_clean", f"""{C},
dc AS (SELECT comment_id,
  {S.remove_stopwords(S.tokenize(S.deep_clean_text('value')))} AS toks FROM comments),
{_lemma_sql('dc', 'comment_id', 'toks', 'out')}
SELECT comment_id, lemmas AS cleaned_comment FROM out""")
def deep_clean(spark, sf):
    """T4 in full: text rules, tokens, stop words, lemmas."""
    d = lemma.deep_clean(comments(spark, sf).select("comment_id", "value"), "value",
                         "cleaned_comment", "comment_id")
    return d.select("comment_id", "cleaned_comment")


@query("tokenize", f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {S.tokenize('text')} AS t FROM documents)""")
def tokenize(spark, sf):
    t = read_table(spark, sf, "documents").select("doc_id", tx.tokenize("text").alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("remove_stopwords", f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {S.remove_stopwords(S.tokenize('text'))} AS t FROM documents)""")
def remove_stopwords(spark, sf):
    t = read_table(spark, sf, "documents").select(
        "doc_id", tx.remove_stopwords(tx.tokenize("text")).alias("t"))
    return t.select("doc_id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query("lemmatize", f"""WITH tk AS (SELECT doc_id, {S.tokenize('text')} AS toks FROM documents),
{_lemma_sql('tk', 'doc_id', 'toks', 'out')}
SELECT doc_id, lemmas FROM out""")
def lemmatize(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", tx.tokenize("text").alias("toks"))
    out = lemma.lemmatize(d, "doc_id", "toks", "lem")
    return out.select("doc_id", F.array_join("lem", " ").alias("lemmas"))


# --- T8, T9 ------------------------------------------------------------------

@query("english_fallback", f"""{KEPT}
SELECT comment_id, {S.is_english('cleaned_comment')} AS is_english FROM kept""")
def english_fallback(spark, sf):
    return _kept(spark, sf).select(
        "comment_id", tx.is_english_fallback(F.col("cleaned_comment")).alias("is_english"))


def _trigram_sql(src: str, id_col: str, text: str) -> str:
    norm = f"lower(trim({S.rx(f'coalesce({text}, {chr(39) * 2})', tx.WS_RUN, ' ')}))"
    return f"""(SELECT {id_col}, substring(t, i, 3) AS gram
  FROM (SELECT {id_col}, t, unnest(range(1, length(t) - 1)) AS i
        FROM (SELECT {id_col}, {norm} AS t FROM {src})))"""


def _detect_sql(src: str, out: str) -> str:
    """CTEs of T9 over ``src (comment_id, cleaned_comment)``; ``out`` has comment_id and b, the best language or null."""
    return f"""tg AS {_trigram_sql("documents WHERE lang IS NOT NULL", "lang", "text")},
counts AS (SELECT lang, gram, count(*) AS c FROM tg GROUP BY lang, gram),
vv AS (SELECT count(DISTINCT gram) AS v FROM counts),
per_lang AS (SELECT lang, sum(c) AS n_l FROM counts GROUP BY lang),
docs AS (SELECT lang, count(*) AS docs FROM documents WHERE lang IS NOT NULL GROUP BY lang),
alld AS (SELECT count(*) AS n FROM documents WHERE lang IS NOT NULL),
langs AS (SELECT p.lang, ln(d.docs / alld.n) AS log_prior, ln(p.n_l + vv.v) AS log_norm
          FROM per_lang p JOIN docs d USING (lang), vv, alld),
profile AS (SELECT gram, lang, ln(c + 1.0) AS log_c FROM counts),
dg AS (SELECT comment_id, gram, count(*) AS n FROM {_trigram_sql(src, "comment_id", "cleaned_comment")}
       GROUP BY comment_id, gram),
tot AS (SELECT comment_id, sum(n) AS t_d FROM dg GROUP BY comment_id),
mm AS (SELECT comment_id, lang, sum(n * log_c) AS hit FROM dg JOIN profile USING (gram)
      GROUP BY comment_id, lang),
sc AS (SELECT comment_id, lang, log_prior - t_d * log_norm + hit AS score
       FROM mm JOIN tot USING (comment_id) JOIN langs USING (lang)),
{out} AS (SELECT comment_id, arg_max(lang, score) AS b FROM sc GROUP BY comment_id)"""


@query("detect_language", f"""{KEPT},
{_detect_sql("kept", "best")}
SELECT k.comment_id,
  CASE WHEN length({_strip_sql('k.cleaned_comment')}) < 10 OR b IS NULL THEN 'unknown' ELSE b END
    AS detected_language
FROM kept k LEFT JOIN best USING (comment_id)""")
def detect_language(spark, sf):
    """Trigram model trained on labelled documents, applied to comments."""
    model = language.train(read_table(spark, sf, "documents"), "text", "lang")
    return language.detect_ids(_kept(spark, sf).select("comment_id", "cleaned_comment"), model,
                               "comment_id", "cleaned_comment")


def detector(spark, sf):
    """T9 as the cleaning job's language step."""
    model = language.train(read_table(spark, sf, "documents"), "text", "lang")
    return lambda d: language.detect(d, model, "comment_id", "cleaned_comment")


# --- T10–T12, T16 --------------------------------------------------------------

_SENT_SQL = (f"list_transform(list_filter(string_split_regex(coalesce(text, ''), '[.!?]+'), "
             f"lambda s: length({S.rx('s', tx.WS_RUN)}) > 0), "
             f"lambda s: len(regexp_extract_all(s, {S.lit(tx.NON_WS_RUN)}, 1)))")


@query("sentence_lengths", f"""SELECT doc_id, len(w) AS n_sentences,
  CAST(coalesce(list_sum(w), 0) AS BIGINT) AS n_words, coalesce(list_max(w), 0) AS max_words
FROM (SELECT doc_id, {_SENT_SQL} AS w FROM documents)""")
def sentence_lengths(spark, sf):
    d = read_table(spark, sf, "documents").select(
        "doc_id", tx.sentence_word_counts("text").alias("w"))
    return d.select("doc_id", F.size("w").alias("n_sentences"),
                    F.aggregate("w", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_words"),
                    F.coalesce(F.array_max("w"), F.lit(0)).alias("max_words"))


@query("extract_words", f"""SELECT doc_id, len(w) AS n_words, array_to_string(w, ' ') AS words
FROM (SELECT doc_id, {S.words('text')} AS w FROM documents)""")
def extract_words(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", tx.words("text").alias("w"))
    return d.select("doc_id", F.size("w").alias("n_words"), F.array_join("w", " ").alias("words"))


@query("text_key", f"""{KEPT}
SELECT comment_id, md5(value) AS text_key,
  md5(cleaned_comment || '_' || array_to_string(list_sort({S.extract_aspects('cleaned_comment', FIXTURE_LEXICON)}), '_')) AS absa_key
FROM kept""")
def text_key(spark, sf):
    """MD5 key of the raw text and of (clean text, sorted aspects)."""
    d = _kept(spark, sf)
    return d.select("comment_id", tx.text_key("value").alias("text_key"),
                    tx.absa_key("cleaned_comment", extract_aspects(F.col("cleaned_comment"), FIXTURE_LEXICON))
                    .alias("absa_key"))


@query("tokens_fixed_length", f"""SELECT doc_id,
  array_to_string(list_resize(list_slice(t, 1, 128), 128, '<pad>'), ' ') AS tokens_128,
  array_to_string(list_resize(list_slice(t, 1, 512), 512, '<pad>'), ' ') AS tokens_512
FROM (SELECT doc_id, {S.tokenize('text')} AS t FROM documents)""")
def tokens_fixed_length(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", tx.tokenize("text").alias("t"))
    return d.select("doc_id", F.array_join(tx.fixed_length("t", 128), " ").alias("tokens_128"),
                    F.array_join(tx.fixed_length("t", 512), " ").alias("tokens_512"))


# --- P2–P10, P14 -----------------------------------------------------------------

@query("comment_filter", f"{KEPT}\nSELECT comment_id, game_id, cleaned_comment FROM kept")
def comment_filter(spark, sf):
    return _kept(spark, sf).select("comment_id", "game_id", "cleaned_comment")


@query("length_range_filter", f"""{C}
SELECT comment_id, length(c) AS comment_length FROM
  (SELECT comment_id, {S.clean_text('value')} AS c FROM comments) WHERE length(c) BETWEEN 10 AND 5000""")
def length_range_filter(spark, sf):
    d = comments(spark, sf).select("comment_id", tx.clean_text("value").alias("c"))
    return filters.length_range(d, "c", 10, 5000).select(
        "comment_id", F.length("c").cast("bigint").alias("comment_length"))


_NA_LIST = ", ".join(S.lit(t) for t in NA_TOKENS)


@query("na_normalise", f"""{C}
SELECT comment_id, CASE WHEN rating IN ({_NA_LIST}) THEN NULL ELSE rating END AS rating,
       CASE WHEN value IN ({_NA_LIST}) THEN NULL ELSE value END AS value FROM comments""")
def na_normalise(spark, sf):
    c = comments(spark, sf)
    return c.select("comment_id", tx.na_normalise(F.col("rating")).alias("rating"),
                    tx.na_normalise(F.col("value")).alias("value"))


@query("rating_coerce", f"""{C}
SELECT comment_id,
  CASE WHEN regexp_matches(trim(rating), {S.lit(tx.NUMBER)}) THEN TRY_CAST(trim(rating) AS DOUBLE) END
    AS rating_raw,
  coalesce(CASE WHEN regexp_matches(trim(rating), {S.lit(tx.NUMBER)})
                THEN TRY_CAST(trim(rating) AS DOUBLE) END, 0.0) AS rating
FROM comments""")
def rating_coerce(spark, sf):
    """P8 and P9."""
    c = comments(spark, sf)
    return c.select("comment_id", tx.coerce_rating("rating").alias("rating_raw"),
                    tx.rating_or_zero("rating").alias("rating"))


@query("clean_username", f"""{C}
SELECT comment_id, {_strip_sql("coalesce(username, 'anonymous')")} AS username FROM comments""")
def clean_username(spark, sf):
    return comments(spark, sf).select("comment_id", tx.clean_username("username").alias("username"))


@query("language_filter", f"""{KEPT}
SELECT comment_id, 'en' AS detected_language FROM kept WHERE {S.is_english('cleaned_comment')}""")
def language_filter(spark, sf):
    """P6 over the T8 rule (langdetect is not part of the environment)."""
    d = language.english_fallback(_kept(spark, sf), "cleaned_comment")
    return filters.language_filter(d, "detected_language", ["en"]).select(
        "comment_id", "detected_language")


@query("collect_clean", f"""{KEPT}
SELECT comment_id, cleaned_comment, CASE WHEN regexp_matches(trim(rating), {S.lit(tx.NUMBER)})
  THEN TRY_CAST(trim(rating) AS DOUBLE) END AS rating, 'en' AS detected_language
FROM kept WHERE {S.is_english('cleaned_comment')}""")
def collect_clean(spark, sf):
    """The library's cleaning step with its language filter."""
    d = jobs.collect_clean(comments(spark, sf), languages=("en",))
    return d.select("comment_id", "cleaned_comment", "rating", "detected_language")


@query("comments_page", f"""{KEPT}
SELECT comment_id, game_id, {_strip_sql("coalesce(username, 'anonymous')")} AS username,
       strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, cleaned_comment
FROM kept WHERE game_id = 'src3' ORDER BY comment_id LIMIT 20 OFFSET 5""")
def comments_page(spark, sf):
    """One page of one game's comments."""
    d = _kept(spark, sf).select(
        "comment_id", "game_id", tx.clean_username("username").alias("username"),
        F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at"), "cleaned_comment")
    return filters.comments_page(d, "src3", limit=20, offset=5)


CLEAN_JOB_CTES = f"""{C},
lc AS (SELECT * REPLACE (nullif({S.clean_text_tags('value')}, '') AS value) FROM comments),
dd AS (SELECT * FROM lc QUALIFY row_number() OVER (PARTITION BY game_id, value ORDER BY comment_id) = 1),
dc AS (SELECT comment_id,
  {S.remove_stopwords(S.tokenize(S.deep_clean_text('value')))} AS toks FROM dd),
{_lemma_sql('dc', 'comment_id', 'toks', 'out')},
j AS (SELECT dd.*, out.lemmas AS cleaned_comment FROM dd JOIN out USING (comment_id)),
r AS (SELECT * FROM j WHERE length(cleaned_comment) BETWEEN 10 AND 5000),
{_detect_sql("r", "best")},
g AS (SELECT r.*, CASE WHEN length({_strip_sql('cleaned_comment')}) < 10 OR b IS NULL THEN 'unknown' ELSE b END AS detected_language
      FROM r LEFT JOIN best USING (comment_id))"""

CLEAN_JOB_SELECT = f"""SELECT comment_id, game_id, {_strip_sql("coalesce(username, 'anonymous')")} AS username,
  coalesce(CASE WHEN regexp_matches(trim(rating), {S.lit(tx.NUMBER)})
                THEN TRY_CAST(trim(rating) AS DOUBLE) END, 0.0) AS rating,
  cleaned_comment, detected_language, CAST(length(cleaned_comment) AS BIGINT) AS comment_length
FROM g WHERE detected_language IN ('en') AND length({S.rx('cleaned_comment', tx.WS_RUN)}) > 0"""


@query("clean_job", f"{CLEAN_JOB_CTES}\n{CLEAN_JOB_SELECT}")
def clean_job(spark, sf):
    """P10 + the ETL cleaning job end to end (cleaned_at left out of the oracle)."""
    d = jobs.clean_job(comments(spark, sf), detector(spark, sf))
    return d.select("comment_id", "game_id", "username", "rating", "cleaned_comment",
                    "detected_language", F.col("comment_length").cast("bigint").alias("comment_length"))


# --- W1–W3, U1, U2 --------------------------------------------------------------

@query("dedup_comments", """SELECT doc_id, source, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY source, text ORDER BY doc_id) = 1""")
def dedup_comments(spark, sf):
    """W1 on (game, text), first in id order."""
    d = read_table(spark, sf, "documents").select("doc_id", "source", "text", "n_chars")
    return dedup.dedup_first(d, ["source", "text"], "doc_id").select("doc_id", "source", "n_chars")


@query("cap_per_game", """SELECT conv_id, turn, role FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 3""")
def cap_per_game(spark, sf):
    """First 3 turns per conversation (game = conv_id, order = turn)."""
    c = read_table(spark, sf, "conversations").select("conv_id", "turn", "role")
    return dedup.cap_per_group(c, "conv_id", "turn", 3)


@query("top_games", f"WITH {S.GAMES_CTE}\nSELECT game_id, name, rank FROM games ORDER BY rank LIMIT 10")
def top_games(spark, sf):
    """The 10 best-ranked games."""
    from opinari.sources.tables import games
    return dedup.top_n(games(spark, sf), "rank", 10)


@query("union_games", f"""{C}
SELECT comment_id, game_id, value, NULL::VARCHAR AS lang FROM comments WHERE game_id = 'src1'
UNION ALL SELECT comment_id, game_id, NULL::VARCHAR AS value, lang FROM comments WHERE game_id = 'src2'
UNION ALL SELECT comment_id, game_id, value, lang FROM comments WHERE game_id NOT IN ('src1', 'src2')""")
def union_games(spark, sf):
    """Per-game frames with different columns appended by name."""
    c = comments(spark, sf)
    a = c.filter(F.col("game_id") == "src1").select("comment_id", "game_id", "value")
    b = c.filter(F.col("game_id") == "src2").select("comment_id", "game_id", "lang")
    rest = c.filter(~F.col("game_id").isin("src1", "src2")).select("comment_id", "game_id", "value", "lang")
    return dedup.union_all(a, b, rest).select("comment_id", "game_id", "value", "lang")


@query("removed_rows", f"""{C},
f AS (SELECT comment_id FROM comments WHERE value IS NOT NULL AND length(value) > 10
      AND length({S.clean_text('value')}) > 0)
SELECT comment_id, CASE WHEN value IS NULL THEN 'null_text' WHEN length(value) <= 10 THEN 'too_short'
  ELSE 'empty_after_cleaning' END AS reason
FROM comments WHERE comment_id NOT IN (SELECT comment_id FROM f)""")
def removed_rows(spark, sf):
    """Rows removed by the comment filter, with the first failed rule."""
    c = comments(spark, sf)
    kept = filters.comment_filter(c, "value")
    reason = (F.when(F.col("value").isNull(), "null_text")
              .when(F.length("value") <= 10, "too_short").otherwise("empty_after_cleaning"))
    return dedup.removed_rows(c, kept, "comment_id", reason).select("comment_id", "reason")
