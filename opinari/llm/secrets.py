"""Secret scan with multipart credential linking, in DataFrame functions only.

Per kind the matches of a text and the pieces between them (one ``split`` and
one ``regexp_extract_all`` of the same pattern) give the lengths from which a
running sum makes code point positions, relationally: one row per match, so
a text with very many matches costs no more per match than others.

Base kinds are reported wherever they stand. Weak candidates are reported
only with their complements: texts' parts are put in order of position and
each candidate meets, in one window pass per text (a sort-merge interval join
with scopes of ``SCOPE`` code points around each part, no pairs are made), the
nearest access identifier, secret and endpoint on either side:

* ``key``: a run of exactly 40 base64 characters with upper-case, lower-case and
  digit, if an access identifier is in scope;
* ``client``: an identifier of the kinds ASIA, AROA, AIDA, if a secret is in scope;
* ``endpoint``: a URL, if both an access identifier and a secret are in scope.

Defined results: null counts as empty; a text without parts has the counts 0,
an empty span list and its digest; positions are code points, ends
exclusive; repeated rows give repeated results (rows are told apart by a
number of their own); an empty table gives no rows. Only the named columns
are read; :func:`redact` hands on all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinari.llm.common import fresh, written
from opinari.operators.base import with_columns_once

SCOPE = 300

#: Kinds in their order of report: (pattern, what a match needs, gate that a text must meet).
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KEY = r"[A-Za-z0-9+/]{40,}"
CLIENT = r"(?:ASIA|AROA|AIDA)[A-Z0-9]{16,}"
ENDPOINT = r"""https?://[^\x00-\x20"'<>]+"""

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "client", "endpoint")
_PATTERN = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, KEY, CLIENT, ENDPOINT)))
_IDS, _SECRETS = ("access", "client"), ("assign", "hex", "key")


def _gates(t: Column) -> dict[str, Column]:
    ids = t.contains("AKIA") | t.contains("ASIA") | t.contains("AROA") | t.contains("AIDA")
    return {"assign": t.rlike("(?i:passw|secret|token|api_?key)"), "access": t.contains("AKIA"),
            "hex": t.rlike(HEX), "key": ids, "client": ids, "endpoint": ids}


def suspicious(text: Column) -> Column:
    """False only for texts that cannot hold a part of any base kind or an identifier."""
    g = _gates(F.coalesce(text, F.lit("")))
    return g["assign"] | g["hex"] | g["key"]


def _valid(kind: str, match: Column, value: Column) -> Column:
    if kind == "assign":
        return F.length(value) >= 6
    if kind == "key":
        return (F.length(match) == 40) & match.rlike("[A-Z]") & match.rlike("[a-z]") & match.rlike("[0-9]")
    return F.lit(True)


def _parts(df: DataFrame, text: str) -> DataFrame:
    """``df`` without ``text`` and with ``_<kind>``: array of (gap before, length, valid)."""
    t = F.coalesce(F.col(text), F.lit(""))
    gates, raw = _gates(t), {}
    for k in KINDS:
        raw[f"_m_{k}"] = F.when(gates[k], F.regexp_extract_all(t, F.lit(_PATTERN[k]), F.lit(0)))
        raw[f"_p_{k}"] = F.when(gates[k], F.split(t, _PATTERN[k], -1))
    raw["_v_assign"] = F.when(gates["assign"], F.regexp_extract_all(t, F.lit(ASSIGN), F.lit(2)))
    keep = [c for c in df.columns if c != text]
    out = with_columns_once(df, **raw).drop(text)

    def lengths(k: str) -> Column:
        value = "_v_assign" if k == "assign" else f"_m_{k}"
        zipped = F.arrays_zip(F.col(f"_m_{k}").alias("m"), F.col(value).alias("v"), F.col(f"_p_{k}").alias("p"))
        return F.transform(F.filter(zipped, lambda x: x["m"].isNotNull()),
                           lambda x: F.struct(F.length(x["p"]).cast("long").alias("gap"),
                                              F.length(x["m"]).cast("long").alias("len"),
                                              _valid(k, x["m"], x["v"]).alias("valid")))

    return out.select(*keep, *[lengths(k).alias(f"_{k}") for k in KINDS])


def _spans(parts: DataFrame, row: str) -> DataFrame:
    """(row, kind, number, start, end) of every valid base match and of every weak one with its complements."""
    def tag(n: int):
        return lambda x, i: F.struct(F.lit(n).alias("no"), i.alias("i"), x.alias("x"))

    none = F.array().cast(parts.schema[f"_{KINDS[0]}"].dataType)
    tagged = F.concat(*[F.transform(F.coalesce(F.col(f"_{k}"), none), tag(n)) for n, k in enumerate(KINDS)])
    each = parts.select(row, F.explode(tagged).alias("t")) \
        .select(row, F.col("t.no").alias("no"), F.col("t.i").alias("i"), "t.x.gap", "t.x.len", "t.x.valid")
    so_far = Window.partitionBy(row, "no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(so_far)
    each = each.select(row, "no", "valid", "len", end.alias("end")).where("valid") \
        .select(row, "no", (F.col("end") - F.col("len")).alias("start"), "end")
    order = Window.partitionBy(row).orderBy("start", "no")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)

    def near(kinds) -> Column:
        mine = F.col("no").isin(*[KINDS.index(k) for k in kinds])
        left = F.col("start") - F.max(F.when(mine, F.col("end"))).over(before)
        right = F.min(F.when(mine, F.col("start"))).over(after) - F.col("end")
        return F.coalesce(left <= SCOPE, F.lit(False)) | F.coalesce(right <= SCOPE, F.lit(False))

    linked = each.select("*", near(("access",)).alias("by_access"), near(_IDS).alias("by_id"),
                         near(_SECRETS).alias("by_secret"))
    no = {k: F.col("no") == n for n, k in enumerate(KINDS)}
    return linked.where((F.col("no") < len(BASE)) | no["key"] & F.col("by_access") | no["client"] & F.col("by_secret")
                        | no["endpoint"] & F.col("by_id") & F.col("by_secret")) \
        .select(row, "no", "start", "end")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and spans, an array of (start, no, kind, end) in order of
    position; ``no`` is the kind's number."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    parts = written(_parts(rows, "_text").withColumn("row", F.monotonically_increasing_id()), "parts")
    some = F.lit(False)
    for k in KINDS:
        some = some | (F.coalesce(F.size(f"_{k}"), F.lit(0)) > 0)
    spans = _spans(parts.where(some), "row")
    names = F.array(*[F.lit(k) for k in KINDS])
    lists = spans.groupBy("row").agg(F.array_sort(F.collect_list(
        F.struct("start", "no", names[F.col("no")].alias("kind"), "end"))).alias("spans"))
    empty = F.array().cast(lists.schema["spans"].dataType)
    loud = parts.where(some).select("row", "doc_id").join(lists, "row", "left")
    return loud.select("doc_id", F.coalesce("spans", empty).alias("spans")) \
        .union(parts.where(~some).select("doc_id", empty.alias("spans")))


def op7(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["no"] < len(BASE))
    def of(i: int):
        return lambda s: s["no"] == i

    n = [F.size(F.filter("spans", of(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE)]
    return scan(docs).select("doc_id", *n, F.sha2(told(base), 256).alias("base_sha256"),
                             told(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]", length: str | None = None) -> DataFrame:
    """``docs`` with every reported span (overlapping ones merged) replaced by ``mark``; ``length`` names
    a column that holds the text's length and follows it. Texts without a span stay as they are."""
    quiet = docs.where(~suspicious(F.col(text)))
    row = fresh(docs, "_row")
    loud = written(docs.where(suspicious(F.col(text))).withColumn(row, F.monotonically_increasing_id()), "suspicious")
    spans = _spans(_parts(loud.select(F.col(row).alias("_r"), F.col(text).alias("_text")), "_text"), "_r")
    order = Window.partitionBy("_r").orderBy("start", "no")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    group = F.sum(F.when(F.col("start") > F.coalesce(F.col("reach"), F.lit(-1)), 1).otherwise(0)).over(
        order.rowsBetween(Window.unboundedPreceding, 0))
    merged = spans.withColumn("reach", reach).withColumn("g", group) \
        .groupBy("_r", "g").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    before = F.lag("end", 1, 0).over(Window.partitionBy("_r").orderBy("start"))
    cuts = merged.withColumn("before", before).groupBy("_r").agg(
        F.array_sort(F.collect_list(F.struct("start", "before", "end"))).alias("_cuts"))
    t = F.col(text)
    kept = F.transform("_cuts", lambda c: F.concat(
        F.substr(t, (c["before"] + 1).cast("int"), (c["start"] - c["before"]).cast("int")), F.lit(mark)))
    last = F.element_at("_cuts", -1)["end"].cast("int")
    new = F.concat(F.array_join(kept, ""), F.substr(t, last + 1, F.length(t)))
    found = fresh(docs, "_new")
    joined = loud.join(cuts, loud[row] == cuts["_r"], "left")
    joined = with_columns_once(joined, **{found: F.when(F.col("_cuts").isNotNull(), new)})
    changed = {text: F.coalesce(F.col(found), t)}
    if length:
        changed[length] = F.when(F.col(found).isNotNull(), F.length(found).cast(docs.schema[length].dataType)) \
            .otherwise(F.col(length))
    return quiet.union(joined.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns]))
