import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opinari.llm import periodic

from .helpers import SCHEMA, edge_rows, rows


def plain(w, least=24, times=3):
    """Every run by its definition: maximal stretches of every period that have no smaller one."""
    out, n = [], len(w)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                s = w[i:i + length]
                if not any(all(s[k] == s[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((i, length, q))
            i = max(j, i) + 1
    return sorted(out)


def periods(r, n, alphabet):
    """Random words with repeated stretches, some of them nested or neighbouring."""
    w = []
    while len(w) < n:
        kind = r.random()
        if kind < 0.4:
            w += [r.randrange(alphabet) for _ in range(r.randrange(1, 30))]
        else:
            root = [r.randrange(alphabet) for _ in range(r.randrange(1, 60))]
            if r.random() < 0.3:
                root = root * 2 + root[:r.randrange(len(root) + 1)]
            w += (root * 9)[:int(len(root) * (2.5 + 4 * r.random()))]
    return w[:n]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 20, 1000])
def test_runs_against_the_definition(alphabet):
    r = random.Random(alphabet)
    for _ in range(60):
        w = periods(r, r.randrange(0, 500), alphabet)
        assert periodic.runs(np.array(w, dtype=np.int64)) == plain(w)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=30), st.integers(3, 6), st.lists(st.integers(0, 1), max_size=20))
def test_small_alphabets(root, times, tail):
    w = root * times + tail
    assert periodic.runs(np.array(w, dtype=np.int64)) == plain(w)


def test_every_period_of_the_scales():
    r = random.Random(3)
    for q in range(1, 130):
        root = [r.randrange(10**6) for _ in range(q)]
        length = max(24, 3 * q)
        w = [r.randrange(10**6) for _ in range(r.randrange(40))]
        at = len(w)
        w += (root * 24)[:length] + [-5, -6]
        assert periodic.runs(np.array(w, dtype=np.int64)) == [(at, length, q)]


def test_long_period_and_interface():
    r = random.Random(4)
    root = [r.randrange(10**6) for _ in range(30_000)]
    assert periodic.runs(np.array(root * 3 + [-1], dtype=np.int64)) == [(0, 90_000, 30_000)]
    assert periodic.runs(np.array(root, dtype=np.int64)) == []
    with pytest.raises(ValueError):
        periodic.runs(np.zeros(50, dtype=np.int64), times=2)


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain(w) if n < 3000 else [(0, n, 1)] * 0
    gone = {i for s, l, q in found for i in range(s + q, s + l)}
    best = None
    for s, l, q in found:
        if best is None or l * best[2] > best[1] * q:
            best = (s, l, q)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            digest("".join(f"{s},{l},{q}\n" for s, l, q in found)),
            digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query_against_the_definition(spark, clashing, edge, nothing):
    r = random.Random(9)
    odd = [(5000 + k, " ".join(f"w{x}" for x in periods(r, r.randrange(1, 400), 50)), "en", "s", 1) for k in range(120)]
    odd += [(6000, "A a " * 40, "en", "s", 1), (6001, " x  y\x0b" * 30, "en", "s", 1), (6001, "x\t" * 24, "en", "s", 1),
            (6002, "x " * 23, "en", "s", 1), (None, "x\n" * 30, "en", "s", 1)]
    data = [x for x in edge_rows() if len(x[1] or "") < 20_000] + odd
    assert sum(zlib.crc32(str(x[0]).encode()) % 10 == 0 for x in data if x[0] is not None) > 5
    got = periodic.op12(spark.createDataFrame(data, SCHEMA))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((expected(x[0], x[1]) for x in data), key=repr)
    assert rows(periodic.op12(clashing)) == rows(periodic.op12(edge))
    assert periodic.op12(nothing).count() == 0


def test_texts_and_spans(spark):
    docs = spark.createDataFrame([(1, "a  b\nc " + "x y " * 15 + "end")], "id long, body string")
    got = periodic.periodic_runs(docs, "id", "body").first()
    assert got["collapsed"] == "a b c x y end" and got["n_words"] == 34
    assert [tuple(r) for r in got["runs"]] == [(3, 30, 2)]
