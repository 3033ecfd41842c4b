import math
from collections import defaultdict

import numpy as np
from .helpers import SCHEMA, prose, rows

from opinari.llm import neardup
from opinari.llm.components import components
from opinari.llm.neardup import Params, near_duplicates, one_of_each

THREE = Params(shingle=3, percent=85, rows=8)


def brute(data, size, percent):
    """doc_id -> (set size, component) of ``(doc_id, text)``."""
    sets = {}
    for d, t in data:
        w = (t or "").encode().lower().split()
        s = {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
        sets[d] = s
    ids, par = sorted(sets), {d: d for d in sets}

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                n = len(x & y)
                if 100 * n >= percent * (len(x) + len(y) - n):
                    p, q = find(a), find(b)
                    par[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d)) for d in ids}


def edited(text, seed, share):
    r = np.random.default_rng(seed)
    w = text.split()
    for i in r.choice(len(w), max(1, int(len(w) * share)), replace=False):
        w[i] = f"edit{r.integers(1 << 30)}"
    return " ".join(w)


def test_against_brute_force(spark):
    base = prose(1, 400, 3000)
    data = [(k, prose(100 + k, 60 + k, 3000)) for k in range(60)]
    data += [(100 + k, base) for k in range(40)]                                   # exact copies
    data += [(200 + k, edited(base, k, 0.004 + 0.0015 * (k % 30))) for k in range(90)]  # near copies, some beyond the limit
    data += [(400, None), (401, ""), (402, "one"), (403, "One"), (404, "one two"), (405, "a b c"), (406, "A  B\tc")]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in data], SCHEMA)
    for p in (THREE, Params()):
        want = brute(data, p.shingle, p.percent)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, p).collect()}
        assert got == want


def form_letters(n, seed, partners):
    """``n`` letters of 200 words with six places to fill in, 83 % alike; each of the last ``partners`` has one
    place in common with another letter, 86 % alike."""
    r = np.random.default_rng(seed)
    base = [f"form{i}" for i in range(200)]
    places = np.arange(5, 195, 33)
    out = []
    for k in range(n):
        w = list(base)
        for i in places:
            w[i] = f"own{r.integers(1 << 40)}"
        out.append(w)
    for k in range(partners):
        out[n - 1 - k][places[0]] = out[k][places[0]]
    return [" ".join(w) for w in out]


def test_form_letters_without_a_hub(spark):
    p = Params(shingle=3, percent=85, rows=8, centres=3)
    texts = form_letters(1200, 4, 150)
    data = list(enumerate(texts))
    sets = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in map(str.split, texts)]

    def near(a, b):
        return 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    assert not any(near(a, b) for a, b in np.random.default_rng(5).integers(0, 1000, (5000, 2)) if a != b)
    assert all(near(k, 1199 - k) for k in range(150))
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in data], SCHEMA).coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs, p).collect()}
    assert got == {d: 1199 - d if d > 1049 else d for d in range(1200)}


def test_blocks_of_the_rest(spark, monkeypatch):
    texts = form_letters(80, 6, 12)
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in enumerate(texts)], SCHEMA).coalesce(1)
    monkeypatch.setattr(neardup, "BLOCK", 7)
    want = brute(list(enumerate(texts)), 3, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, THREE).collect()}
    assert got == want


def test_the_smallest_sets_that_can_be_linked(spark):
    """A word more at either end: 4 shingles in 5 (five words, 80 %), 6 in 7 (three words, 85 %)."""
    data = []
    for k in range(20):
        for at, n in ((0, 8), (100, 7), (200, 6)):
            w = [f"w{k}x{at}x{i}" for i in range(n + 1)]
            data += [(1000 * k + at, " ".join(w[:-1])), (1000 * k + at + 1, " ".join(w)), (1000 * k + at + 2, " ".join(["z", *w[:-1]]))]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in data], SCHEMA)
    for p in (THREE, Params()):
        want = brute(data, p.shingle, p.percent)
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_duplicates(docs, p).collect()}
        assert got == want and any(c != d for d, (_, c) in got.items())


def test_edge_rows(edge, clashing, nothing):
    out = near_duplicates(edge, THREE)
    assert out.count() == edge.count()
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in out.collect()}
    assert {(1, 1, True), (2, 2, True), (3, 3, True), (6, 6, True), (7, 6, False), (None, None, True)} <= got
    assert rows(out) == rows(near_duplicates(clashing, THREE))
    assert near_duplicates(nothing, THREE).count() == 0
    left = one_of_each(clashing)
    assert left.columns == clashing.columns
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert ids.count("6") == 1 and "7" not in ids and ids.count("None") == 2 and ids.count("1") == 1


def test_repeated_ids_with_different_texts(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    data = [(3, a), (7, a), (7, b), (7, b), (7, b + " end"), (8, c), (8, d), (9, d + " end"), (9, None), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in data], SCHEMA)
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(docs).collect())
    assert got == sorted([(3, 3, True), (7, 3, False), (7, 7, True), (7, 7, True), (7, 7, True), (8, 8, True), (8, 8, True),
                          (9, 8, False), (9, 9, True), (9, 9, True)])
    left = [(r["doc_id"], (r["text"] or "")[:2]) for r in one_of_each(docs).collect()]
    assert sorted(left) == [(3, "a0"), (7, "b0"), (8, "c0"), (8, "d0"), (9, ""), (9, "")]


def test_one_permutation_estimates():
    """Equal bins of densified signatures estimate the similarity."""
    r = np.random.default_rng(3)
    for n, common in ((40, 30), (400, 200), (5000, 4000)):
        got = []
        for _ in range(30):
            x = r.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64)
            a, b = np.unique(x[:n]), np.unique(x[n - common:])
            got.append((neardup.signature(a, 256) == neardup.signature(b, 256)).mean())
        true = common / (2 * n - common)
        assert abs(np.mean(got) - true) < 4 * math.sqrt(true * (1 - true) / 256 / 30) + 0.03


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(5, 5), (130, 3), (None, 7), (200, 201), (201, 200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["component"] for r in components(df).collect()}
    par = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            par[a].add(b)
            par[b].add(a)
    for start in par:
        seen, todo = {start}, [start]
        while todo:
            for y in par[todo.pop()] - seen:
                seen.add(y)
                todo.append(y)
        assert got[start] == min(seen)
    assert set(got) == set(par)
    assert components(df.limit(0)).count() == 0
