"""File sources: CSV (S1), XML payloads (S3, S4), page reconciliation (S5),
corrupt-record quarantine (S6) and layer listing (S14).

Landed files are read with an explicit schema (nothing is inferred). XML
pages are parsed with the built-in ``from_xml`` (a column of payloads) or the
``xml`` data source (landed files); attributes become ``_name`` fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinari.functions import text as tx
from opinari.operators.base import with_columns_once
from opinari.sources.csv import read_csv


def read_comments_csv(spark: SparkSession, path: str, schema: T.StructType,
                      na_columns=("rating",)) -> DataFrame:
    """S1 + P4: header row, quoted fields with newlines and doubled quotes, files
    split among tasks (see :mod:`opinari.sources.csv`); pandas' NA tokens become
    null in ``na_columns`` (text columns keep them)."""
    df = read_csv(spark, path, schema)
    for c in na_columns:
        if c in df.columns:
            df = df.withColumn(c, tx.na_normalise(F.col(c)))
    return df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header; arrays and maps go through ``to_json``."""
    cols = [F.to_json(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
            for f in df.schema.fields]
    (df.select(*cols).write.mode(mode).option("header", True).option("quote", '"')
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


# --- XML ---------------------------------------------------------------------

def xml_escape(c: Column) -> Column:
    """Escape text for an XML attribute; line breaks and tabs as character
    references so attribute normalisation keeps them."""
    out = c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;"),
                 ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#9;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


# Keep attribute values byte for byte (the reader trims them by default).
XML_OPTIONS = {"ignoreSurroundingSpaces": "false"}


def _attr(name: str, c: Column) -> Column:
    return F.when(c.isNotNull(), F.concat(F.lit(f'{name}="'), xml_escape(c), F.lit('"')))


def comment_pages(comments: DataFrame, page_size: int = 100) -> DataFrame:
    """Build API-shaped XML pages from a comment table: one payload per
    (game, id block of ``page_size``), so each page holds at most
    ``page_size`` comments and no group grows with the data. Each payload
    carries the game's declared comment total (one row per game, joined to the
    pages, of which there is one per block)."""
    totals = comments.groupBy("game_id").agg(F.count(F.lit(1)).alias("total"))
    elem = F.concat(F.lit("<comment "), F.concat_ws(
        " ", _attr("id", F.col("comment_id").cast("string")), _attr("username", F.col("username")),
        _attr("rating", F.col("rating")), _attr("value", F.col("value"))), F.lit("/>"))
    pages = (comments.withColumn("page", (F.col("comment_id") / page_size).cast("long"))
             .groupBy("game_id", "page")
             .agg(F.array_join(F.array_sort(F.collect_list(F.struct("comment_id", elem.alias("x"))))
                               .getField("x"), "").alias("body")))
    item = F.concat(F.lit('<item id="'), xml_escape(F.col("game_id")), F.lit('"><comments totalitems="'),
                    F.col("total").cast("string"), F.lit('">'), F.col("body"), F.lit("</comments></item>"))
    return pages.join(totals, "game_id").select("game_id", "page", item.alias("item")) \
        .withColumn("payload", F.concat(F.lit("<items>"), F.col("item"), F.lit("</items>")))


_COMMENTS = T.StructType([
    T.StructField("_totalitems", T.LongType()),
    T.StructField("comment", T.ArrayType(T.StructType([
        T.StructField("_id", T.LongType()),
        T.StructField("_username", T.StringType()),
        T.StructField("_rating", T.StringType()),
        T.StructField("_value", T.StringType()),
    ]))),
])

#: A page holds any number of items.
COMMENT_PAGE_SCHEMA = T.StructType([
    T.StructField("item", T.ArrayType(T.StructType([
        T.StructField("_id", T.StringType()), T.StructField("comments", _COMMENTS)]))),
    T.StructField("_corrupt_record", T.StringType()),
])


def _rest(pages: DataFrame, payload_col: str) -> list[str]:
    return [c for c in pages.columns if c != payload_col]


def _parsed(pages: DataFrame, payload_col: str, schema: T.StructType) -> DataFrame:
    """``pages`` with the parsed payload ``_x``; computed once, so filters above do not parse again.
    White space between elements means nothing here, but would count as content (an
    attribute cannot hold a bare ``<``)."""
    plain = F.regexp_replace(F.trim(F.col(payload_col)), r">\s+<", "><")
    parsed = F.from_xml(plain, schema, {**XML_OPTIONS, "mode": "PERMISSIVE"})
    return with_columns_once(pages, _x=parsed)


def _broken() -> Column:
    return F.col("_x").isNull() | F.col("_x._corrupt_record").isNotNull() | F.col("_x.item").isNull()


def corrupt_pages(pages: DataFrame, payload_col: str = "payload",
                  schema: T.StructType | None = None) -> DataFrame:
    """S6 for XML: the pages whose payload is null, does not parse or holds no
    item, with the raw payload."""
    return _parsed(pages, payload_col, schema or COMMENT_PAGE_SCHEMA).filter(_broken()).drop("_x")


def parse_comment_pages(pages: DataFrame, payload_col: str = "payload") -> DataFrame:
    """S3: XML comment pages → one row per comment with the game id attached
    (the collector's reading: nested ``comments`` element, ``value``
    attribute). An item that declares a total but holds no comment gives one
    row with null comment columns, so its total is not lost. Broken pages are
    in :func:`corrupt_pages`; the rest goes on."""
    rest = _rest(pages, payload_col)
    items = _parsed(pages, payload_col, COMMENT_PAGE_SCHEMA).filter(~_broken()) \
        .select(F.explode("_x.item").alias("_item"), *rest)
    rows = items.select("_item._id", "_item.comments._totalitems", F.explode_outer("_item.comments.comment").alias("c"), *rest)
    return rows.select(F.col("_id").alias("game_id"), F.col("_totalitems").alias("declared_total"),
                       *[c for c in rest if c not in ("game_id", "declared_total")],
                       F.col("c._id").alias("comment_id"), F.col("c._username").alias("username"),
                       F.col("c._rating").alias("rating"), F.col("c._value").alias("value"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """S3/S4, landed files: one row per XML file with its path and whole
    payload, for the ``parse_*`` functions. A page is one API answer, so a file
    is small; broken files reach the quarantine instead of failing the read."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload"))


GAME_ITEM_SCHEMA = T.StructType([
    T.StructField("item", T.ArrayType(T.StructType([
        T.StructField("_id", T.StringType()),
        T.StructField("name", T.StructType([T.StructField("_value", T.StringType())])),
        T.StructField("statistics", T.StructType([T.StructField("ratings", T.StructType([
            T.StructField("ranks", T.StructType([T.StructField("rank", T.StructType([
                T.StructField("_value", T.StringType())]))]))]))])),
    ]))),
    T.StructField("_corrupt_record", T.StringType()),
])


def parse_game_pages(pages: DataFrame, payload_col: str = "payload") -> DataFrame:
    """Ranking pages, any number of games each → ``(id, name, rank)`` with
    the defaults ``'Unknown'`` and ``'0'`` for a missing name or rank. Broken
    pages make no row; :func:`corrupt_pages` has them."""
    items = _parsed(pages, payload_col, GAME_ITEM_SCHEMA).filter(~_broken()).select(F.explode("_x.item").alias("g"))
    return items.select(
        F.col("g._id").alias("id"), F.coalesce(F.col("g.name._value"), F.lit("Unknown")).alias("name"),
        F.coalesce(F.col("g.statistics.ratings.ranks.rank._value"), F.lit("0")).alias("rank"))


def page_reconciliation(parsed: DataFrame, totals: DataFrame, page_size: int = 100) -> DataFrame:
    """``totals (game_id, declared_total)``, as the first answer of each game
    declares them, give the expected pages ``ceil(total / page_size)``; the pages
    and comments that landed are counted beside them. A game none of whose
    pages landed stands with zeros."""
    landed = parsed.filter(F.col("comment_id").isNotNull()).groupBy("game_id").agg(
        F.count_distinct("page").alias("pages_landed"), F.count(F.lit(1)).alias("comments_landed"))
    expected = F.ceil(F.col("declared_total") / page_size).cast("long")
    return totals.join(landed, "game_id", "left").select(
        "game_id", "declared_total", expected.alias("expected_pages"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("pages_landed", "comments_landed")]) \
        .withColumn("missing_pages", F.col("expected_pages") - F.col("pages_landed")) \
        .withColumn("complete", (F.col("missing_pages") <= 0) & (F.col("comments_landed") >= F.col("declared_total")))


# --- corrupt records, listing -------------------------------------------------

def read_json_quarantine(spark: SparkSession, path: str, schema: T.StructType,
                         corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """PERMISSIVE read; good rows and the quarantine (raw text of the
    records that did not parse). Bad input never fails the job.

    The parsed records are written once to a table in the shared folder and
    both sides are read from it: Spark refuses plans over raw files that
    reference only the corrupt-record column (which column pruning produces
    for a plain count), and the landing files are parsed only once."""
    from opinari.session import scratch_path

    full = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    parsed_path = scratch_path(spark, "parsed-json")
    (spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
     .json(path).write.mode("overwrite").parquet(parsed_path))
    df = spark.read.parquet(parsed_path)
    good = df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.filter(F.col(corrupt_col).isNotNull()).select(corrupt_col)
    return good, bad


def split_csv(spark: SparkSession, path: str, schema: T.StructType,
              corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """S6 for CSV: rows that fit the schema, and the raw text of those that do not (a value of another type,
    too many or too few columns). Parsed once, into the shared folder."""
    from opinari.session import scratch_path

    full = T.StructType(schema.fields + [T.StructField(corrupt_col, T.StringType())])
    parsed = scratch_path(spark, "parsed-csv")
    read_csv(spark, path, full, corrupt_col).write.parquet(parsed)
    df = spark.read.parquet(parsed)
    return (df.filter(F.col(corrupt_col).isNull()).drop(corrupt_col),
            df.filter(F.col(corrupt_col).isNotNull()).select(corrupt_col))


def list_layer(spark: SparkSession, path: str) -> DataFrame:
    """Key, size and last-modified time of every file under a layer;
    the file content column is pruned, so no file is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
            .select("path", "length", "modificationTime"))
