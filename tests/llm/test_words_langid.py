import re

import numpy as np
import pyarrow as pa
import pytest
from .helpers import rows

from opinari.llm import langid, words

TEXTS = ["Hello, wörld  HELLO\n", None, "", "x", "a b", "b" * 70_000, "  lead x9", "é" * 3 + " z", "w%d " * 40_000,
         "a" * 65_536 + " b", ("ab " * 30_000) + "tail"]


@pytest.mark.parametrize("table,pattern", [(words.SPACED, rb"[^\x20\x09-\x0d]+"), (words.ALNUM, rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_against_re(table, pattern):
    low = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
    seen = 0
    for i, j, first, h, start, end, base in words.slices(pa.array(TEXTS), table):
        raw, _ = words.buffers(pa.array(TEXTS))
        for k in range(i, j):
            want = re.findall(pattern, (TEXTS[k] or "").encode().translate(low))
            lo, hi = first[k - i], first[k - i + 1]
            assert hi - lo == len(want)
            assert [words.hash_word(w.decode()) for w in want[:40]] == h[lo:hi][:40].tolist()
            got = [raw[base + s:base + e].tobytes().translate(low) for s, e in zip(start[lo:hi], end[lo:hi])]
            assert got == want
            seen += 1
    assert seen == len(TEXTS)


def test_sliced_column():
    whole = pa.array(["zero", "one two", None, "three"])
    got = [(i, j, h.tolist()) for i, j, _, h, *_ in words.slices(whole.slice(1, 3), words.SPACED)]
    assert got == [(0, 3, [words.hash_word(w) for w in ("one", "two", "three")])]


def test_edge_rows(edge, clashing, nothing):
    out = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.op8(edge).collect()}
    assert langid.op8(edge).count() == edge.count()
    for k in (1, 2, 3, 4):
        assert (k, "und", 0.0) in out
    assert all(0 <= s <= 1 and p in ("en", "de", "fr", "und") for _, p, s in out)
    assert any(d == 8 and p != "und" for d, p, _ in out)
    assert rows(langid.op8(edge)) == rows(langid.op8(clashing))
    assert langid.op8(nothing).count() == 0
    kept = langid.language_stage(clashing)
    assert kept.columns == clashing.columns and {1, 2, 3, 4}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_nothing_to_learn_from(edge):
    from pyspark.sql import functions as F
    bare = edge.withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in langid.op8(bare).collect()} == {("und", 0.0)}


def test_pieces_of_long_texts_add_up():
    text = ("Él niño comió " * 9000)
    count = np.zeros(langid.BUCKETS, dtype=int)
    for _, border, ids in langid._features([text], langid.BUCKETS, 3):
        assert border[-1] == len(ids)
        count += np.bincount(ids, minlength=langid.BUCKETS)
    whole, langid._PIECE = langid._PIECE, 1 << 30
    try:
        other = np.zeros(langid.BUCKETS, dtype=int)
        for _, _, ids in langid._features([text], langid.BUCKETS, 3):
            other += np.bincount(ids, minlength=langid.BUCKETS)
    finally:
        langid._PIECE = whole
    assert (count == other).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.op8(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert out.where("lang = lang_pred").count() / out.count() > 0.98
