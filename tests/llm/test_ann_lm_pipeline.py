import math
import re
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from opinari.llm import ann, lm, neardup, secrets
from opinari.llm.common import documents

from .helpers import SCHEMA, edge_rows, prose, rows

VECTORS = "vec_id long, embedding array<float>, label int, score string"


def exact(data, asked, k):
    good = {}
    for i, v in data:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, dtype=np.float32).astype(np.float64))
    size = Counter(len(v) for vs in good.values() for v in vs).most_common(1)[0][0] if good else 0
    out = {}
    for q in asked:
        for a in good.get(q, [])[:1]:
            if len(a) == size:
                s = [(-round(float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b)), 12), i)
                     for i, bs in good.items() for b in bs if i != q and len(b) == size]
                out[q] = [i for _, i in sorted(s)[:k]]
    return out


def test_neighbours_of_odd_vectors(spark):
    r = np.random.default_rng(2)
    data = [(k, r.normal(size=8).tolist()) for k in range(300)]
    data += [(1000 + k, data[50][1]) for k in range(60)] + [(2000 + k, [2 * x for x in data[100][1]]) for k in range(8)]
    data += [(400, None), (401, []), (402, [0.0] * 8), (403, [None] * 8), (404, [float("nan")] * 8), (405, [1.0] * 7), (None, [1.0] * 8),
             (450, [float("inf")] + [0.0] * 7)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], VECTORS)
    got = {}
    for x in ann.op3(df).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append(x["vec_id"])
    assert got == exact(data, [q for q, _ in data if q is not None and q % 50 == 0], 5)
    assert ann.op3(df.limit(0)).count() == 0
    two = spark.createDataFrame([(50, [1.0, 0.0], 1, "x"), (7, [1.0, 1.0], 1, "x"), (7, [1.0, 1.0], 1, "x")], VECTORS)
    assert [(x["query_id"], x["rank"], x["vec_id"]) for x in ann.op3(two).collect()] == [(50, 1, 7)]


def test_recall(spark):
    df = documents(spark, "/root/testdata/sf0.1", "embeddings")
    data = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = exact(data, [i for i, _ in data if i % 50 == 0], 5)
    got = {}
    for x in ann.op3(df).collect():
        got.setdefault(x["query_id"], set()).add(x["vec_id"])
    assert sum(len(got[q] & set(w)) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_recall_of_many_random_vectors(spark, tmp_path):
    """Vectors without any structure, 200,000 of them: the number of lists must not lower recall."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    n, d, k = 200_000, 64, 5
    x = np.random.default_rng(11).normal(size=(n, d)).astype(np.float32)
    flat = pa.ListArray.from_arrays(pa.array(np.arange(0, n * d + 1, d), pa.int32()), pa.array(x.ravel()))
    pq.write_table(pa.table({"vec_id": np.arange(n), "embedding": flat}), str(tmp_path / "v.parquet"), row_group_size=20_000)
    df = spark.read.parquet(str(tmp_path / "v.parquet"))
    got = {}
    for r in ann.search(df, df.where("vec_id % 200 = 0"), k).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    right = 0
    for q in range(0, n, 1000):
        s = u @ u[q]
        s[q] = -2
        right += len(got[q] & set(np.argpartition(-s, k)[:k].tolist()))
    print("recall", right / (k * (n // 1000)))
    assert right >= 0.95 * k * (n // 1000)


def test_small_blocks_give_the_same(spark, monkeypatch):
    df = documents(spark, "/root/testdata/sf0.001", "embeddings")
    want = rows(ann.op3(df).select("query_id", "rank", "vec_id"))
    monkeypatch.setattr(ann, "BLOCK", 3)
    assert rows(ann.op3(df).select("query_id", "rank", "vec_id")) == want


def test_vectors_of_two_lengths(spark):
    """The commonest length of the vectors counts for the queries, too."""
    r = np.random.default_rng(4)
    for odd in (3, 5):
        data = [(k, r.normal(size=odd if k % 50 == 0 else 4).tolist()) for k in range(200)]
        df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
        assert ann.op3(df).count() == 0
        got = ann.search(df, df.where("vec_id % 50 in (0, 1)"), 2)
        assert sorted({x["query_id"] for x in got.collect()}) == [1, 51, 101, 151]
    tie = [(k, [1.0, 0.0] if k % 2 else [1.0, 0.0, 0.0]) for k in range(1, 101)]            # as many of each: the shorter
    df = spark.createDataFrame(tie, "vec_id long, embedding array<double>")
    assert ann.op3(df).count() == 0 and ann.search(df, df.where("vec_id = 7"), 3).select("vec_id").collect() == [(1,), (3,), (5,)]


def test_clashing_names(spark):
    r = np.random.default_rng(5)
    data = [(k, r.normal(size=4).tolist()) for k in range(120)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    extra = df.selectExpr("*", *[f"'x' AS `{c}`" for c in ("id", "v", "list", "score", "rank", "query_id", "h1", "d", "ids")])
    assert rows(ann.op3(extra)) == rows(ann.op3(df))


def lm_brute(data, backoff=0.4):
    w = [[x.decode() for x in re.findall(rb"[0-9a-z\x80-\xff]+", (t or "").encode().lower())] for _, t in data]
    c, pairs = Counter(x for d in w for x in d), Counter(p for d in w for p in zip(d, d[1:]))
    total, out = sum(c.values()), []
    for (i, _), d in zip(data, w):
        mine, ours = Counter(d), Counter(zip(d, d[1:]))
        rest = max(total - len(d), 1)
        s, n = (math.log(max(c[d[0]] - mine[d[0]], 1) / rest) if d else 0.0), 0
        for p in zip(d, d[1:]):
            if pairs[p] > ours[p]:
                s += math.log((pairs[p] - ours[p]) / (c[p[0]] - mine[p[0]]))
            else:
                s, n = s + math.log(backoff * max(c[p[1]] - mine[p[1]], 1) / rest), n + 1
        out.append((i, len(d), n, round(s, 4)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,head", [(1 << 17, 1 << 10), (150, 8), (1, 1)])
def test_backoff_against_brute_force(spark, edge, clashing, nothing, size, head):
    data = [(r[0], r[1]) for r in edge_rows()]
    got = sorted(((r["doc_id"], r["n_words"], r["n_backoff"], round(r["log_prob"], 4))
                  for r in lm.score(edge, size=size, head=head).collect()), key=repr)
    want = lm_brute(data)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) <= 2e-4 for g, w in zip(got, want))
    assert lm.score(nothing).count() == 0
    assert lm.score(clashing).count() == edge.count()


def test_bitmap_of_keys(spark):
    """Every key may be held; few others while the bitmap follows the keys, all of them where it is full."""
    r = np.random.default_rng(6)
    keys, others = r.integers(-1 << 63, 1 << 63, 40_000), r.integers(-1 << 63, 1 << 63, 40_000)
    df = spark.createDataFrame([(int(k),) for k in keys], "pair long").repartition(5)
    held = lm.held_keys(df)
    assert held.may(keys).all() and 0.01 < held.may(others).mean() < 0.1
    many = spark.range(2_000_000).withColumnRenamed("id", "pair")
    assert lm.held_keys(many, 1 << 15).may(others).all()
    assert not lm.held_keys(df.limit(0)).may(keys).any() and not len(held.may(keys[:0]))


def test_stages(spark, edge, clashing, nothing):
    sf = "/root/testdata/sf0.001"
    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
        docs = out
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, sf).count() > 0 and last(spark, nothing, sf).count() == 0


def test_pipeline_decisions(spark):
    sf = "/root/testdata/sf0.001"
    item = documents(spark, sf, "benchmark").orderBy("item_id").first()["text"]
    clean = [(k, prose(k, 150, 4000), "en", "s", len(prose(k, 150, 4000))) for k in range(40)]
    odd = [(900, "1234 5678", "en", "s", 9), (901, clean[3][1], "en", "s", 1), (902, clean[4][1] + " one more", "en", "s", 1),
           (903, prose(77, 200, 4000) + " " + item + " " + prose(78, 200, 4000), "en", "s", 1),
           (904, prose(79, 80, 4000) + " token = abcdef0123456789", "en", "s", 1)]
    docs = spark.createDataFrame(clean + odd, SCHEMA)
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.written(stage(spark, docs, sf), "test")
    left = {r["doc_id"]: r for r in docs.collect()}
    assert set(left) == {*range(40), 903, 904}
    assert all(left[k]["text"] == clean[k][1] and left[k]["n_chars"] == clean[k][4] for k in range(40))
    assert item not in left[903]["text"] and left[903]["text"].startswith(prose(77, 200, 4000)[:500])
    assert left[904]["text"].endswith("[SECRET]") and left[904]["n_chars"] == len(left[904]["text"])
    assert neardup.near_duplicates(docs).where("not kept").count() == 0
    assert secrets.op7(docs).where("spans != ''").count() == 0


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
