import re

import pytest

from opinari.llm import licenses, urls

from .helpers import SCHEMA, edge_rows, prose, rows

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
FOLD = {i: i + 32 for i in range(65, 91)}
TEXTS = ["Released under the MIT License.", "under the mit license under the mit license", "x Under, THE\nmit-license! y",
         "Licensed under the Apache License, Version 2.0. and cc by-nc 4.0", "license " * 3000 + "under the mit license",
         "under the mit\u212A license", "this work is licensed under the gnu general public license, version 3", "the mit license",
         "cc by nc cc by nc", "under the mit", "version 2 apache license version", "é" + "under the mit license"]


def test_licences_against_brute_force(spark, clashing, edge, nothing):
    data = edge_rows() + [(800 + k, t, "en", "s", 1) for k, t in enumerate(TEXTS)]
    out = licenses.op2(spark.createDataFrame(data, SCHEMA))
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out.collect()), key=repr)
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    want = []
    for d, t, *_ in data:
        w = WORD.findall((t or "").translate(FOLD))
        at = {k: [i for i in range(len(w)) if w[i:i + len(p.split())] == p.split()] for k, p in phrases.items()}
        every = [i for x in at.values() for i in x]
        want.append((d, len(w), len(every), min(every, default=None), max(every, default=None), ",".join(sorted(k for k in at if at[k]))))
    assert got == sorted(want, key=repr)
    by = {r["doc_id"]: r for r in out.collect()}
    assert by[806]["labels"] == "gpl-3" and by[806]["base_labels"] == "" and by[800]["labels"] == "mit" and by[800]["score"] == 1.0
    assert all(0 <= r["score"] <= 1 for r in by.values())
    assert rows(licenses.op2(clashing)) == rows(licenses.op2(edge))
    assert licenses.op2(nothing).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


URLS = [None, "", "no scheme", "http://", "http://WWW.Example.COM/en/1?x#y", "https://a.example.com/en/", "https://example.com/english",
        "https://example.com", "https://example.com?x=/en/", "http://b.example.net/fr/9", "http://net/es/", "http://spam-farm.example.org/x",
        "http://sub.cheap-pills.example.com/a", "ftp://x.org/a://b/c", "http://a..com/x", "http://.com/", "http://É.com/é/x", "http://com/#f",
        "http://x.example.org/en/\nfoo", "http://spam-farm.example.org.evil.org/"]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = host.translate(FOLD)
    fits = [(len(h + p), len(h), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    listed = any(host == h or host.endswith("." + h) for h in urls.HOSTS)
    if fits:
        return host, path, max(fits)[2], max(fits)[3]
    return host, path, None, "block" if listed else "allow"


def test_urls_against_brute_force(spark):
    r = [(k, u, "h") for k, u in enumerate(URLS * 2)] + [(None, URLS[4], None)]
    pages = spark.createDataFrame(r, "page_id long, url string, html string")
    got = sorted((tuple(x) for x in urls.op10(pages).collect()), key=repr)
    assert got == sorted(((k, *brute(u)) for k, u, _ in r), key=repr)
    assert urls.op10(pages.limit(0)).count() == 0
    assert rows(urls.op10(pages.withColumnRenamed("html", "rule"))) == rows(urls.op10(pages))


@pytest.mark.parametrize("n,listed", [(20_000, 700), (3_000, 1), (300, 300), (300, 0)])
def test_cascade_is_exact(spark, n, listed):
    from pyspark.sql import functions as F
    universe = spark.range(n).select(F.concat(F.lit("key"), "id").alias("key"))
    keys = spark.range(listed).select(F.concat(F.lit("key"), F.col("id") * (n // max(listed, 1))).alias("key"))
    c = urls.cascade(keys, universe.union(universe))
    import numpy as np
    rows_ = universe.select("key", F.xxhash64("key").alias("h")).toPandas()
    got = set(rows_["key"][c.listed(rows_["h"].to_numpy().view(np.uint64))])
    assert got == {r["key"] for r in keys.collect()}


def test_empty_lists_allow(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    out = urls.judge(pages, spark.createDataFrame([], "verdict string, host string, path string"), spark.createDataFrame([], "host string"))
    assert {(r["rule"], r["verdict"]) for r in out.collect()} == {(None, "allow")}


def test_prose_has_no_licence():
    assert "license" not in prose(1, 100)
