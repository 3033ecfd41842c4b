"""URL filters by a Bloom filter cascade: exact membership without joins.

Level 0 encodes the listed keys; level 1 the keys of the corpus that pass level
0 without being listed; level 2 the listed keys that pass level 1; and so on
until nothing passes wrongly. Over the corpus's complete key universe the
first level that a key fails tells exactly whether it is listed. Level 0's
rate of false positives is chosen so that level 1 is about as large as level
0, so the cascade grows with the list, not with the corpus; a filter above
``MAX_BITS`` is refused.

Filters are built by tasks: each sets its rows' bits in a partial bitmap, and
words of the bitmaps are or-ed by a shuffle. A key of a URL is a host suffix
with a path prefix of a shape (labels, path length) that occurs among the
rules; the longest key that is a rule wins, ties go to the longer host. URLs
without a rule are blocked if their host or a parent domain is on the list of
hosts, else allowed.

Defined results: null URLs and URLs without ``://`` have an empty host and
path, no rule, and are allowed; rules with equal host and path count once, a
block before an allow; null hosts or paths in the lists are no rules; empty
lists leave every URL allowed; repeated rows give equal rows; an empty table
gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.llm.common import written
from opinari.llm.words import mix64

MAX_BITS = 1 << 31          # 256 MB
MAX_SHAPES = 1_000
MAX_LEVELS = 60

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Bloom:
    bits: np.ndarray         # uint64 words
    hashes: int
    seed: int

    def positions(self, h: np.ndarray, k: int) -> np.ndarray:
        salt = np.uint64((self.seed * 64 + k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return mix64(h + salt) % np.uint64(len(self.bits) * 64)

    def __contains__(self, _):
        raise TypeError("use passes()")

    def passes(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), dtype=bool)
        for k in range(self.hashes):
            at = self.positions(h, k)
            ok &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return ok


@dataclass
class Cascade:
    levels: list[Bloom] = field(default_factory=list)

    def listed(self, h: np.ndarray) -> np.ndarray:
        """Which keys of the universe are listed."""
        out = np.zeros(len(h), dtype=bool)
        at = np.arange(len(h))
        for n, level in enumerate(self.levels):
            at = at[level.passes(h[at])]
            out[at] = n % 2 == 0
        return out


def _bloom(keys: DataFrame, n: int, rate: float, seed: int) -> Bloom:
    """A filter of the ``n`` hashes in column ``h``."""
    hashes = max(1, round(-math.log2(rate)))
    size = max(64, math.ceil(n * hashes / math.log(2) / 64) * 64)
    if size > MAX_BITS:
        raise ValueError(f"a filter of {size} bits is above {MAX_BITS}")
    empty = Bloom(np.zeros(size // 64, dtype=np.uint64), hashes, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros(size // 64, dtype=np.uint64)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(hashes):
                at = empty.positions(h, k)
                np.bitwise_or.at(part, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        at = np.flatnonzero(part)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(part[at].view(np.int64))], names=["word", "bits"])

    words = keys.select("h").mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    got = words.toPandas()       # at most MAX_BITS / 64 rows
    empty.bits[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64).view(np.uint64)
    return empty


def _passing(keys: DataFrame, level: Bloom) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)
    at = keys.columns.index("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(shared.value.passes(h)))

    return keys.mapInArrow(run, keys.schema)


def cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade for the strings ``listed (key)`` over the strings ``universe (key)``."""
    def hashed(df: DataFrame, name: str) -> DataFrame:
        return written(df.where("key is not null").select("key").distinct()
                       .select("key", F.xxhash64("key").alias("h")), name)

    inside = hashed(listed, "listed")
    everything = hashed(universe, "universe")
    n, total = inside.count(), everything.count()
    out = Cascade()
    if not n:
        return out
    rate = min(0.5, math.sqrt(0.5) * n / max(total, 1))
    # ``inside`` are the keys of the level to build, ``outside`` those of the other kind that it must not hold.
    out.levels.append(_bloom(inside, n, rate, 0))
    outside = written(_passing(everything, out.levels[0]).join(inside.select("key"), "key", "left_anti"), "passing")
    while m := outside.count():
        if len(out.levels) == MAX_LEVELS:
            raise RuntimeError("two keys share a hash; choose another hash for one of them")
        out.levels.append(_bloom(outside, m, 0.5, len(out.levels)))
        inside, outside = outside, written(_passing(inside, out.levels[-1]), "passing")
    return out


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _suffix(host: Column, k: Column) -> Column:
    return F.call_function("substring_index", host, F.lit("."), -k)


def _labels(host: Column) -> Column:
    return F.when(host == "", 0).otherwise(F.size(F.split(host, r"\."))).cast("int")


def _keys(pages: DataFrame, shapes: list[tuple[int, int]], depth: int) -> DataFrame:
    """``pages`` (id, host, path) with the candidate keys, best first: ``rules`` (kind r) and ``hosts`` (kind h)."""
    def key(s: Column) -> Column:
        fits = (_labels(F.col("host")) >= s["k"]) & (F.length("path") >= s["n"])
        text = F.concat(_suffix(F.col("host"), s["k"]), F.substring("path", F.lit(1), s["n"]))
        return F.when(fits, F.struct((-F.length(text)).alias("size"), (-s["k"]).alias("k"), text.alias("key")))

    shape = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(n).alias("n")) for k, n in shapes])
    none = F.array().cast("array<string>")
    rules = F.transform(F.array_sort(F.filter(F.transform(shape, key), lambda x: x.isNotNull())),
                        lambda x: F.concat(F.lit("r|"), x["key"])) if shapes else none
    hosts = F.transform(F.sequence(F.lit(1), F.least(_labels(F.col("host")), F.lit(depth))),
                        lambda k: F.concat(F.lit("h|"), _suffix(F.col("host"), k)))
    return pages.select("*", rules.alias("rules"),
                        F.when((F.col("host") != "") & (F.lit(depth) > 0), hosts).otherwise(none).alias("hosts"))


def judge(pages: DataFrame, rules: DataFrame, hosts: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row. ``rules (verdict, host, path)`` with the verdicts
    ``allow`` and ``block``, ``hosts (host)`` the listed hosts."""
    host, path = host_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rules = rules.where("host is not null and path is not null and host != ''") \
        .select("verdict", F.lower("host").alias("host"), "path")
    hosts = hosts.where("host is not null and host != ''").select(F.lower("host").alias("host"))
    shapes = [tuple(r) for r in rules.select(_labels(F.col("host")), F.length("path")).distinct().limit(MAX_SHAPES + 1).collect()]
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"more than {MAX_SHAPES} shapes of rules")
    depth = hosts.agg(F.coalesce(F.max(_labels(F.col("host"))), F.lit(0))).first()[0]
    keyed = _keys(rows, sorted(shapes), depth)
    universe = keyed.select(F.explode(F.concat("rules", "hosts")).alias("key"))
    universe = written(universe.distinct(), "keys")
    name = F.concat(F.lit("r|"), "host", "path").alias("key")
    listed = cascade(rules.select(name).union(hosts.select(F.concat(F.lit("h|"), "host"))), universe)
    blocked = cascade(rules.where("verdict = 'block'").select(name), universe.where("key like 'r|%'"))
    shared = pages.sparkSession.sparkContext.broadcast((listed, blocked))

    def hashes(c: str) -> Column:
        return F.transform(c, lambda k: F.xxhash64(k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, stop = shared.value
        for batch in batches:
            _, hr = _flat(batch.column(4))
            owner, hh = _flat(batch.column(5))
            names = batch.column(3)
            first = np.r_[0, np.cumsum(names.value_lengths().to_numpy(zero_copy_only=False))]
            hit = np.flatnonzero(known.listed(hr))
            best = np.searchsorted(hit, first[:-1])
            best = np.where(best < len(hit), hit[np.minimum(best, max(len(hit) - 1, 0))] if len(hit) else -1, -1)
            ruled = (best >= first[:-1]) & (best < first[1:])
            flat = names.flatten()
            rule = flat.take(pa.array(np.where(ruled, best, 0), mask=~ruled)) if len(flat) else pa.nulls(len(names), pa.string())
            block = np.zeros(len(names), dtype=bool)
            block[owner[known.listed(hh)]] = True
            if ruled.any():
                block[ruled] = stop.listed(hr[best[ruled]])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array([None if r is None else r[2:] for r in rule.to_pylist()], pa.string()),
                 pa.array(np.where(block, "block", "allow"), pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return keyed.select("page_id", "host", "path", "rules", hashes("rules").alias("hr"), hashes("hosts").alias("hh")) \
        .mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and value of every element of a list<long> column."""
    n = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.repeat(np.arange(len(n)), n), column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


#: Rules of the query: verdict, host, path.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))

#: Names of unwanted sites; listed under each of the top-level domains.
SITES = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
HOSTS = tuple(f"{s}.example.{t}" for s in SITES for t in ("com", "net", "org"))


def op10(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict."""
    spark = pages.sparkSession
    return judge(pages, spark.createDataFrame(RULES, "verdict string, host string, path string"),
                 spark.createDataFrame([(h,) for h in HOSTS], "host string"))
