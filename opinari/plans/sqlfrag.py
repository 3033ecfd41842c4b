"""DuckDB SQL fragments for the oracle side of the correctness check.

They spell the same rules as ``opinari.functions`` in DuckDB's dialect (RE2
patterns with the ``'g'`` flag, ``list_*`` functions, ``lambda`` syntax), so
the driver can compare our Spark plans with an independent engine.
"""

from __future__ import annotations

from opinari.config import ENGLISH_WORDS, Lexicon, LexiconScorer, SPARK_ENGLISH_STOPWORDS
from opinari.functions import text as tx


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({expr}, {lit(pattern)}, {lit(repl)}, 'g')"


COMMENTS_CTE = """comments AS (
  SELECT doc_id AS comment_id, source AS game_id,
    CASE WHEN doc_id % 11 = 0 THEN NULL
         ELSE ' user' || CAST(doc_id % 50 AS VARCHAR) || ' ' END AS username,
    CASE doc_id % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN NULL WHEN 2 THEN '7d' WHEN 3 THEN 'nan'
         ELSE CAST(doc_id % 10 + 1 AS VARCHAR) END AS rating,
    CASE WHEN doc_id % 97 = 0 THEN NULL
         WHEN doc_id % 5 = 0 THEN 'see [b]note[/b] http://ex.org/' || CAST(doc_id AS VARCHAR) || '?q=1 ' || text
         WHEN doc_id % 5 = 1 THEN '[IMG]pic' || CAST(doc_id AS VARCHAR) || '[/IMG] www.ex.org ' || text
         WHEN doc_id % 5 = 2 THEN 'me@ex.org says: ' || text
         ELSE text END AS value,
    lang,
    TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL 1 MINUTE AS created_at
  FROM documents)"""

GAMES_CTE = """games AS (
  SELECT game_id, 'Game ' || game_id AS name,
         CAST(row_number() OVER (ORDER BY game_id) AS BIGINT) AS rank
  FROM (SELECT DISTINCT source AS game_id FROM documents))"""


def clean_text(e: str, char_filter: bool = True) -> str:
    t = rx(rx(rx(f"coalesce({e}, '')", tx.LINK_RUN), tx.BRACKETED), tx.WS_RUN, " ")
    if char_filter:
        t = rx(t, tx.NOT_BASIC)
    return f"trim({t})"


def clean_text_tags(e: str) -> str:
    inner = rx(f"coalesce({e}, '')", tx.WS_RUN, " ")
    t = f"trim({inner})"
    for tag in ("[IMG]", "[/IMG]", "[URL]", "[/URL]"):
        t = f"replace({t}, {lit(tag)}, '')"
    return t


def deep_clean_text(e: str, remove_punctuation: bool = False) -> str:
    t = rx(f"trim(coalesce({e}, ''))", tx.WS_RUN, " ")
    for tag in ("IMG", "URL", "QUOTE"):
        t = rx(t, rf"(?s)\[{tag}\].*?\[/{tag}\]")
    t = rx(rx(t, tx.URL), tx.EMAIL)
    t = rx(t, tx.ASCII_PUNCT if remove_punctuation else tx.NOT_KEPT_PUNCT)
    return f"lower({t})"


def tokenize(e: str) -> str:
    return f"regexp_extract_all(lower({e}), {lit(tx.TOKEN)}, 1)"


def stopword_list() -> str:
    return "[" + ", ".join(lit(w) for w in SPARK_ENGLISH_STOPWORDS) + "]"


def remove_stopwords(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: NOT list_contains({stopword_list()}, t))"


def words(e: str) -> str:
    return f"regexp_extract_all(lower(coalesce({e}, '')), {lit(tx.WORD_RUN)}, 1)"


def blank(e: str) -> str:
    return f"({e} IS NULL OR length(trim({e})) = 0)"


def any_contains(low: str, ws) -> str:
    return "(" + " OR ".join(f"contains({low}, {lit(w)})" for w in ws) + ")"


def is_english(e: str) -> str:
    ws_blank = f"({e} IS NULL OR length({rx(e, tx.WS_RUN)}) = 0)"
    return f"(CASE WHEN {ws_blank} THEN false ELSE {any_contains(f'lower({e})', ENGLISH_WORDS)} END)"


def extract_aspects(e: str, lexicon: Lexicon, use_context: bool = True) -> str:
    low = f"lower({e})"
    parts = []
    for a in lexicon.aspects:
        cond = any_contains(low, a.keywords)
        if use_context:
            for g in a.context:
                cond += " AND " + any_contains(low, g)
        parts.append(f"CASE WHEN coalesce({cond}, false) THEN {lit(a.name)} END")
    arr = f"list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL)"
    return f"(CASE WHEN {blank(e)} THEN []::VARCHAR[] ELSE {arr} END)"


def lexicon_x(e: str, scorer: LexiconScorer) -> str:
    low = f"lower({e})"
    pos = " + ".join(f"(CASE WHEN contains({low}, {lit(w)}) THEN 1 ELSE 0 END)" for w in scorer.positive)
    neg = " + ".join(f"(CASE WHEN contains({low}, {lit(w)}) THEN 1 ELSE 0 END)" for w in scorer.negative)
    return f"(({pos}) - ({neg}))"


def lexicon_label(e: str, scorer: LexiconScorer) -> str:
    x = lexicon_x(e, scorer)
    return (f"(CASE WHEN {blank(e)} THEN 'unknown' WHEN {x} > 0 THEN 'positive' "
            f"ELSE 'negative' END)")


def lexicon_conf(e: str, scorer: LexiconScorer) -> str:
    p = f"(1.0 / (1.0 + exp(-{lexicon_x(e, scorer)})))"
    return f"(CASE WHEN {blank(e)} THEN 0.0 ELSE greatest({p}, 1.0 - {p}) END)"


def position(col: str, names) -> str:
    whens = " ".join(f"WHEN {lit(n)} THEN {i}" for i, n in enumerate(names))
    return f"(CASE {col} {whens} END)"


def filtered_comments(char_filter: bool = True) -> str:
    """P2 → P3a → T1 → P5 over the comments CTE."""
    return f"""filtered AS (
  SELECT *, {clean_text('value', char_filter)} AS cleaned_comment FROM comments
  WHERE value IS NOT NULL AND length(value) > 10),
kept AS (SELECT * FROM filtered WHERE length(cleaned_comment) > 0)"""
