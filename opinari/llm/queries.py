"""The thin ``opN_<name>`` queries over the driver's tables, and their DuckDB
SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from opinari.llm import ann, binpack, decontam, langid, licenses, lm, neardup, packing, periodic, secrets, spelling, tokens, urls
from opinari.llm.common import documents

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@query("op8_language_id")
def op8_language_id(spark, sf_dir):
    return langid.op8(documents(spark, sf_dir))


OP6_SQL = """
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 2], ' ') AS x
      FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 2, 1))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON r.id = e.a),
m AS (SELECT id, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM d LEFT JOIN n ON d.doc_id = n.doc_id JOIN m ON d.doc_id = m.id
"""


@query("op6_minhash_near_dedup", OP6_SQL)
def op6_minhash_near_dedup(spark, sf_dir):
    return neardup.near_duplicates(documents(spark, sf_dir), neardup.Params(shingle=3, percent=85, rows=8))


_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', " \
         "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP5_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(10, len(w)) AS size,
              array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS p
             FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (SELECT doc_id, p, size, array_to_string(w[p:p + size - 1], ' ') AS win
       FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS p
             FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN iw ON dw.size = iw.size AND dw.win = iw.win),
pos AS (SELECT doc_id, count(DISTINCT q) AS n_hit
        FROM (SELECT DISTINCT doc_id, unnest(generate_series(p, p + size - 1)) AS q FROM hit) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""


@query("op5_benchmark_decontamination", OP5_SQL)
def op5_benchmark_decontamination(spark, sf_dir):
    return decontam.op5(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def _parts_sql(no: int, pattern: str, valid: str) -> str:
    return f"""SELECT r, {no} AS no, unnest(regexp_extract_all(t, '{pattern}', 0)) AS m,
       unnest(regexp_extract_all(t, '{pattern}', {2 if no == 0 else 0})) AS v,
       unnest(string_split_regex(t, '{pattern}')) AS p,
       unnest(generate_series(1, len(string_split_regex(t, '{pattern}')))) AS k, {no} AS n2
       FROM d WHERE {valid}"""


_ASSIGN_SQL = ("((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"
               "[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)")
_ID_SQL = "regexp_matches(t, 'AKIA|ASIA|AROA|AIDA')"
_NEAR = """coalesce("start" - max(CASE WHEN no IN ({0}) THEN "end" END) OVER b <= 300, false)
     OR coalesce(min(CASE WHEN no IN ({0}) THEN "start" END) OVER a - "end" <= 300, false)"""

OP7_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS ({' UNION ALL '.join([
    _parts_sql(0, _ASSIGN_SQL, 'true'), _parts_sql(1, 'AKIA[A-Z0-9]+', 'true'), _parts_sql(2, '[0-9a-f]+', 'true'),
    _parts_sql(3, '[A-Za-z0-9+/]+', _ID_SQL), _parts_sql(4, '(?:ASIA|AROA|AIDA)[A-Z0-9]+', _ID_SQL),
    _parts_sql(5, secrets.ENDPOINT.replace("'", "''"), _ID_SQL)])}),
runs AS (SELECT r, no, m, v, sum(length(p) + coalesce(length(m), 0)) OVER
           (PARTITION BY r, no ORDER BY k ROWS UNBOUNDED PRECEDING) AS "end" FROM parts),
s AS (SELECT r, no, "end" - length(m) AS "start", "end" FROM runs
      WHERE m IS NOT NULL AND CASE no WHEN 0 THEN length(v) >= 6 WHEN 1 THEN length(m) >= 20 WHEN 2 THEN length(m) >= 24
        WHEN 3 THEN length(m) = 40 AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[0-9]')
        WHEN 4 THEN length(m) >= 20 ELSE true END),
n AS (SELECT *, {_NEAR.format('1')} AS by_access, {_NEAR.format('1, 4')} AS by_id, {_NEAR.format('0, 2, 3')} AS by_secret
      FROM s WINDOW b AS (PARTITION BY r ORDER BY "start", no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    a AS (PARTITION BY r ORDER BY "start", no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
f AS (SELECT r, no, "start", ['assign', 'access', 'hex', 'key', 'client', 'endpoint'][no + 1] || ':' || "start" || ':' || "end" AS x
      FROM n WHERE no < 3 OR (no = 3 AND by_access) OR (no = 4 AND by_secret) OR (no = 5 AND by_id AND by_secret)),
g AS (SELECT r, count(*) FILTER (no = 0) AS a, count(*) FILTER (no = 1) AS c, count(*) FILTER (no = 2) AS h,
             string_agg(x, ',' ORDER BY "start", no) FILTER (no < 3) AS base, string_agg(x, ',' ORDER BY "start", no) AS spans
      FROM f GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.r = g.r
"""


@query("op7_secret_scan", OP7_SQL)
def op7_secret_scan(spark, sf_dir):
    return secrets.op7(documents(spark, sf_dir))


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op1_token_counts")
def op1_token_counts(spark, sf_dir):
    return tokens.op1(documents(spark, sf_dir), vocabulary_path())


@query("op9_packing")
def op9_packing(spark, sf_dir):
    return packing.op9(documents(spark, sf_dir), vocabulary_path())


def _places_sql(words: list[str], lo: int = 0) -> str:
    match = " AND ".join(f"w[p + {i}] = '{x}'" for i, x in enumerate(words))
    return f"list_filter(generate_series(1, len(w)), lambda p: {match})"


def _op2_sql() -> str:
    """Every key phrase at every position; shares of the notices' IDF at those places."""
    index = licenses.Index(licenses.BASE + licenses.NOTICES)
    cols, shares = [], []
    for n, t in enumerate(index.templates):
        lo, hi = t.key
        cols.append(f"{_places_sql(list(t.words[lo:hi]))} AS t{n}")
        whole = sum(index.idf[x] for x in t.words)
        parts = " + ".join(f"CASE WHEN p + {i - lo} >= 1 AND w[p + {i - lo}] = '{x}' THEN {index.idf[x]!r}::DOUBLE ELSE 0.0::DOUBLE END"
                           for i, x in enumerate(t.words))
        shares.append(f"coalesce(list_max(list_transform(t{n}, lambda p: least(({parts}) / {whole!r}::DOUBLE, 1.0::DOUBLE))), 0.0::DOUBLE)")
    base = [n for n, t in enumerate(index.templates) if t.base]

    def labels(numbers):
        names = ", ".join(f"CASE WHEN len(t{n}) > 0 THEN '{index.templates[n].label}' END" for n in numbers)
        return f"coalesce(array_to_string(list_sort(list_distinct([{names}])), ','), '')"

    places = " || ".join(f"t{n}" for n in base)
    return f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
f AS (SELECT doc_id, w, {', '.join(cols)} FROM d)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len({places}) AS BIGINT) AS n_base,
       list_min({places}) - 1 AS first_word, list_max({places}) - 1 AS last_word,
       {labels(base)} AS base_labels, {labels(range(len(index.templates)))} AS labels,
       greatest({', '.join(shares)}) AS score
FROM f"""


@query("op2_license_scan", _op2_sql())
def op2_license_scan(spark, sf_dir):
    return licenses.op2(documents(spark, sf_dir))


def _op10_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)
    hosts = ", ".join(f"'{h}'" for h in urls.HOSTS)
    return f"""
WITH r(verdict, rhost, rpath) AS (VALUES {rules}),
u AS (SELECT page_id, row_number() OVER () AS i,
        CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, i, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT i, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY i)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN len(list_filter([{hosts}],
         lambda h: host = h OR ends_with(host, '.' || h))) > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN m ON p.i = m.i"""


@query("op10_url_filter", _op10_sql())
def op10_url_filter(spark, sf_dir):
    return urls.op10(documents(spark, sf_dir, "pages"))


# All pairs of one query and one candidate: where every list is searched, as in small tables, the search is exact.
OP3_SQL = """
WITH u AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
d AS (SELECT len(e) AS n FROM u GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
v AS (SELECT vec_id, e FROM u JOIN d ON len(e) = n),
p AS (SELECT a.vec_id AS query_id, b.vec_id, max(list_cosine_similarity(a.e, b.e)) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY 1, 2),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op3_nearest_neighbours", OP3_SQL)
def op3_nearest_neighbours(spark, sf_dir):
    return ann.op3(documents(spark, sf_dir, "embeddings"))


OP4_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT r, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM d),
c AS (SELECT x, count(*) AS n FROM t GROUP BY 1),
own AS (SELECT r, x, count(*) AS n FROM t GROUP BY 1, 2),
total AS (SELECT count(*) AS n FROM t),
size AS (SELECT r, count(*) AS n FROM t GROUP BY 1),
b AS (SELECT r, p, x, lag(x) OVER (PARTITION BY r ORDER BY p) AS v FROM t),
mine AS (SELECT r, v, x, count(*) AS n FROM b GROUP BY 1, 2, 3),
pairs AS (SELECT v, x, sum(n) AS n FROM mine WHERE v IS NOT NULL GROUP BY 1, 2),
f AS (SELECT mine.r, mine.n, mine.v, coalesce(pairs.n - mine.n, 0) AS cvx, cv.n - ov.n AS cv, greatest(cx.n - ox.n, 1) AS cx,
             greatest(total.n - size.n, 1) AS rest
      FROM mine JOIN c cx ON cx.x = mine.x JOIN own ox ON ox.r = mine.r AND ox.x = mine.x
      LEFT JOIN c cv ON cv.x = mine.v LEFT JOIN own ov ON ov.r = mine.r AND ov.x = mine.v
      LEFT JOIN pairs ON pairs.v = mine.v AND pairs.x = mine.x JOIN size ON size.r = mine.r, total),
s AS (SELECT r, sum(n * CASE WHEN v IS NULL THEN ln(cx) - ln(rest) WHEN cvx > 0 THEN ln(cvx) - ln(cv)
                             ELSE ln({lm.BACKOFF}::DOUBLE) + ln(cx) - ln(rest) END) AS log_prob,
             CAST(coalesce(sum(n) FILTER (v IS NOT NULL AND cvx = 0), 0) AS BIGINT) AS n_backoff FROM f GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_backoff, 0) AS n_backoff, round(coalesce(log_prob, 0.0), 6) AS log_prob,
       CASE WHEN len(w) > 0 THEN round(log_prob / len(w), 6) END AS score
FROM d LEFT JOIN s ON d.r = s.r
"""


@query("op4_lm_scores", OP4_SQL)
def op4_lm_scores(spark, sf_dir):
    out = lm.score(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_backoff", F.round("log_prob", 6).alias("log_prob"), F.round("score", 6).alias("score"))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    return periodic.op12(documents(spark, sf_dir))


@query("op11_spelling_variants")
def op11_spelling_variants(spark, sf_dir):
    return spelling.op11(documents(spark, sf_dir))


@query("op13_certified_packing")
def op13_certified_packing(spark, sf_dir):
    return binpack.op13(documents(spark, sf_dir), vocabulary_path())
