import random
import re
import zlib
from collections import Counter

import pytest

from opinari.llm import spelling

from .helpers import SCHEMA, rows


def lower(w):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)


def counted(data):
    n = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{w}".encode())
                if h % 97 == 0:
                    at = h % len(w)
                    w = w[:at] + w[at + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def expected(n):
    form, out = {}, {}
    for w in n:
        close = [v for v in n if v != w and near(v, w)]
        best = min(close, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = (form[w], n[w], len(close), form[w] and n[form[w]])
    rows = []
    for w, (f, c, k, m) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, f, root, c, k, m))
    return sorted(rows)


def words_with_edits(r, n, alphabet="abcdefghéÿ×Àz"):
    """Words, some of them an edit or two of earlier ones."""
    words = []
    for _ in range(n):
        if words and r.random() < 0.6:
            w = list(r.choice(words))
            for _ in range(r.randrange(1, 3)):
                at = r.randrange(len(w))
                w[at:at + r.randrange(2)] = r.choice([[], [r.choice(alphabet)]])
            w = "".join(w)
        else:
            w = "".join(r.choice(alphabet) for _ in range(r.randrange(4, 11)))
        words.append(w if len(w) > 2 else "abcde")
    return words


@pytest.mark.parametrize("tile", [4096, 5])
def test_variants_against_every_pair(spark, tile):
    r = random.Random(tile)
    n = {w: r.choice([3, 3, 4, 6, 8, 12, 30, 100]) for w in words_with_edits(r, 500) if len(w) >= 4}
    got = spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long"), tile=tile)
    assert sorted(tuple(x) for x in got.collect()) == expected(n)


def test_group_numbers_change_nothing(spark):
    r = random.Random(8)
    n = {w: r.randrange(3, 60) for w in words_with_edits(r, 200)}
    table = spark.createDataFrame(list(n.items()), "word string, n long")
    assert all(sorted(tuple(x) for x in spelling.variants(table, groups=g).collect()) == expected(n) for g in (1, 2, 7))
    assert [spelling.group_count(x) for x in (0, 1_000_000, 1_000_001, 4_000_001)] == [4, 4, 5, 6]


def test_chains_and_ties(spark):
    n = {"aaaaa": 3, "aaaab": 7, "aaabb": 15, "aabbb": 31, "abbbb": 63, "bbbbb": 127, "zzzzz": 9, "zzzzy": 20, "zzzzx": 20}
    got = {x["word"]: x for x in spelling.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()}
    assert {got[w]["root"] for w in n if w[0] in "ab"} == {"bbbbb"} and got["zzzzz"]["form"] == "zzzzx"
    assert sorted(tuple(x) for x in got.values()) == expected(n)


def test_query_against_every_pair(spark, edge, clashing, nothing):
    r = random.Random(2)
    words = words_with_edits(r, 300)
    data = [(k, " ".join(r.choice(words).capitalize() if r.random() < 0.2 else r.choice(words) for _ in range(60)) + r.choice([".", "-x", "_Ab1c"]),
             "en", "hot", 1) for k in range(150)]
    data += [(None, "Words WORDS words wordß " * 2, None, None, 1), (7, None, None, None, 0), (8, "", None, None, 0)]
    data += [(900 + k, "q" * 20_000 + " " + "q" * 19_999 + "x × ÷÷÷÷÷÷ ÀÀÀÀÀ àÀÀÀÀ", None, None, 1) for k in range(4)]
    data += data[:3]
    n = counted(data)
    assert any(len(w) > 19_000 for w in n)
    got = spelling.op11(spark.createDataFrame(data, SCHEMA))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(tuple(x) for x in got.collect()) == expected(n)
    assert rows(spelling.op11(clashing)) == rows(spelling.op11(edge))
    assert spelling.op11(nothing).count() == 0
