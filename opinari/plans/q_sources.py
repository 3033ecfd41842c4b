"""Source queries: S1, S3–S6, S14. File round trips write to a fresh folder
under the session's shared directory (``spark.checkpoint.dir``)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinari.config import NA_TOKENS
from opinari.plans import sqlfrag as S
from opinari.plans.registry import query
from opinari.session import scratch_path
from opinari.sources import files, sinks
from opinari.sources.tables import comments, games

C = f"WITH {S.COMMENTS_CTE}"
_NA = ", ".join(S.lit(t) for t in NA_TOKENS)

RAW_CSV = T.StructType([
    T.StructField("comment_id", T.LongType()), T.StructField("game_id", T.StringType()),
    T.StructField("username", T.StringType()), T.StructField("rating", T.StringType()),
    T.StructField("value", T.StringType()),
])


@query("scan_csv_roundtrip", f"""{C}
SELECT comment_id, game_id, username, CASE WHEN rating IN ({_NA}) THEN NULL ELSE rating END AS rating,
  value FROM comments""")
def scan_csv_roundtrip(spark, sf):
    """S1 + S8: comments written as CSV (quoted newlines, doubled quotes) and
    read back with a fixed schema; NA tokens normalised in ``rating``."""
    path = scratch_path(spark, "csv-comments")
    files.write_csv(comments(spark, sf).select(*RAW_CSV.fieldNames()), path)
    return files.read_comments_csv(spark, path, RAW_CSV)


def _bundled(pages, items: str = "item"):
    """Pages that hold several items: those of one page number together."""
    body = F.array_join(F.array_sort(F.collect_list(items)), "")
    return pages.groupBy("page").agg(F.concat(F.lit("<items>"), body, F.lit("</items>")).alias("payload"))


def _break():
    """Every seventh page number breaks off in the middle."""
    cut = F.substr("payload", F.lit(1), F.length("payload") - 12)
    return F.when(F.col("page") % 7 == 0, cut).otherwise(F.col("payload"))


@query("xml_comments", f"""{C}
SELECT game_id, comment_id, username, rating, value FROM comments WHERE (comment_id // 100) % 7 <> 0""")
def xml_comments(spark, sf):
    """S3: comments → XML pages of several games each, some of them broken →
    parsed back with ``from_xml``; broken pages are left out."""
    pages = _bundled(files.comment_pages(comments(spark, sf))).select("page", _break().alias("payload"))
    parsed = files.parse_comment_pages(pages)
    return parsed.select("game_id", "comment_id", "username", "rating", "value")


@query("xml_games", f"""WITH {S.GAMES_CTE}
SELECT game_id AS id, CASE WHEN rank % 3 = 0 THEN 'Unknown' ELSE name END AS name,
  CASE WHEN rank % 4 = 0 THEN '0' ELSE CAST(rank AS VARCHAR) END AS rank FROM games WHERE ((rank - 1) // 4) % 7 <> 1""")
def xml_games(spark, sf):
    """Ranking pages of four games each, where every third game lacks a name
    and every fourth a rank element; defaults fill them, and one page is broken."""
    g = games(spark, sf)
    name = F.when(F.col("rank") % 3 != 0, F.concat(F.lit('<name value="'), files.xml_escape(F.col("name")),
                                                  F.lit('"/>'))).otherwise(F.lit(""))
    rank = F.when(F.col("rank") % 4 != 0, F.concat(
        F.lit('<statistics><ratings><ranks><rank value="'), F.col("rank").cast("string"),
        F.lit('"/></ranks></ratings></statistics>'))).otherwise(F.lit(""))
    item = F.concat(F.lit('<item id="'), files.xml_escape(F.col("game_id")), F.lit('">'), name, rank, F.lit("</item>"))
    number = F.floor((F.col("rank") - 1) / 4)
    pages = _bundled(g.select(number.alias("page"), item.alias("item")))
    broken = F.when(F.col("page") % 7 == 1, F.substr("payload", F.lit(1), F.length("payload") - 12))
    return files.parse_game_pages(pages.select(F.coalesce(broken, "payload").alias("payload")))


@query("page_reconciliation", f"""{C},
t AS (SELECT game_id, count(*) AS declared_total FROM comments GROUP BY game_id UNION ALL SELECT 'none', 12),
l AS (SELECT game_id, count(DISTINCT comment_id // 100) AS pages_landed, count(*) AS comments_landed
      FROM comments WHERE NOT ((comment_id // 100) % 5 = 1 AND game_id IN ('src1', 'src2')) GROUP BY game_id),
j AS (SELECT t.game_id, declared_total, CAST(ceil(declared_total / 5.0) AS BIGINT) AS expected_pages,
        coalesce(pages_landed, 0) AS pages_landed, coalesce(comments_landed, 0) AS comments_landed
      FROM t LEFT JOIN l USING (game_id))
SELECT *, expected_pages - pages_landed AS missing_pages,
  expected_pages <= pages_landed AND comments_landed >= declared_total AS complete FROM j""")
def page_reconciliation(spark, sf):
    """Declared totals (their own table, with a game of which nothing landed)
    against pages of which some did not land. A page has five comments of a
    game."""
    c = comments(spark, sf)
    totals = c.groupBy("game_id").agg(F.count(F.lit(1)).alias("declared_total"))
    totals = totals.union(spark.createDataFrame([("none", 12)], "game_id string, declared_total long"))
    pages = files.comment_pages(c)
    landed = pages.filter(~((F.col("page") % 5 == 1) & F.col("game_id").isin("src1", "src2")))
    return files.page_reconciliation(files.parse_comment_pages(landed.drop("game_id", "item")), totals, page_size=5)


@query("quarantine_corrupt", f"""{C}
SELECT 'json' AS format, comment_id AS record, username IS NULL AS quarantined FROM comments
UNION ALL SELECT 'csv', comment_id, comment_id % 13 = 0 FROM comments
UNION ALL SELECT 'xml', page, page % 7 = 0 FROM (SELECT DISTINCT comment_id // 100 AS page FROM comments)""")
def quarantine_corrupt(spark, sf):
    """JSON lines that break off, CSV rows whose id is no number and XML pages
    that break off. The good records go on, the broken ones stand in the
    quarantine as raw text, from which their number is read here."""
    c = comments(spark, sf).select(*RAW_CSV.fieldNames())
    at = scratch_path(spark, "json-comments")
    line = F.to_json(F.struct(*RAW_CSV.fieldNames()))
    broken = F.when(F.col("username").isNull(), F.substr(line, F.lit(1), F.length(line) - 2)).otherwise(line)
    c.select(broken.alias("value")).write.text(at)
    good, bad = files.read_json_quarantine(spark, at, RAW_CSV)
    out = _split("json", good.select("comment_id"), bad, r'"comment_id":([0-9]+)')
    at = scratch_path(spark, "csv-broken")
    number = F.col("comment_id").cast("string")
    files.write_csv(c.withColumn("comment_id", F.when(F.col("comment_id") % 13 == 0, F.concat(F.lit("no"), number)).otherwise(number)), at)
    good, bad = files.split_csv(spark, at, RAW_CSV)
    out = out.union(_split("csv", good.select("comment_id"), bad, r"^no([0-9]+)"))
    pages = _bundled(files.comment_pages(comments(spark, sf))).select("page", _break().alias("payload"))
    bad = files.corrupt_pages(pages)
    kept = pages.join(bad.select("page"), "page", "left_anti").select("page")
    return out.union(kept.select(F.lit("xml"), "page", F.lit(False))).union(bad.select(F.lit("xml"), "page", F.lit(True)))


def _split(name: str, good, bad, number: str):
    got = F.regexp_extract("_corrupt_record", number, 1).cast("long")
    return good.select(F.lit(name).alias("format"), F.col("comment_id").alias("record"), F.lit(False).alias("quarantined")) \
        .union(bad.select(F.lit(name), got, F.lit(True)))


@query("list_layer")
def list_layer(spark, sf):
    """S9 + S14: load comments into the raw layer by ingest date, then list
    the layer's files (content column pruned)."""
    base = scratch_path(spark, "lake")
    path = sinks.load_raw(comments(spark, sf).select(*RAW_CSV.fieldNames()), base, "2024-01-01")
    return files.list_layer(spark, path)
