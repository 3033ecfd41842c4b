import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from opinari.llm import binpack, tokens, wordids
from opinari.llm.queries import vocabulary_path

from .helpers import SCHEMA, edge_rows
from .test_tokens_packing import ODD


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.load(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def one_by_one(lengths, window):
    """Best fit decreasing by the definition: the windows' rooms."""
    rooms = []
    for n in lengths:
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms[rooms.index(min(fits))] -= n
        else:
            rooms.append(window - n)
    return sorted(rooms)


def fewest(lengths, window):
    """The least number of windows, by trying all."""
    best = len(lengths)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        seen = set()
        for i, r in enumerate(rooms):
            if r >= lengths[k] and r not in seen:
                seen.add(r)
                rooms[i] -= lengths[k]
                go(k + 1, rooms)
                rooms[i] += lengths[k]
        rooms.append(window - lengths[k])
        go(k + 1, rooms)
        rooms.pop()
    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_against_one_by_one(seed):
    r = random.Random(seed)
    for _ in range(60):
        window = r.choice([10, 64, 2048])
        top = r.choice([window, max(2, window // 3), max(2, window // 2)])
        lengths = sorted((r.randrange(1, top + 1) for _ in range(r.randrange(0, 120))), reverse=True)
        number, offset, left = binpack.best_fit(np.array(lengths, dtype=np.int64), window)
        assert sorted(left.tolist()) == one_by_one(lengths, window)
        inside = defaultdict(list)
        for n, k, at in zip(lengths, number.tolist(), offset.tolist()):
            inside[k].append((at, n))
        for k, found in inside.items():
            at = 0
            for o, n in sorted(found):
                assert o == at
                at += n
            assert at == window - left[k]


def test_bound_never_above_the_fewest():
    r = random.Random(5)
    tight = 0
    for _ in range(150):
        window = r.choice([12, 20, 30])
        lengths = sorted((r.randrange(1, window + 1) for _ in range(r.randrange(1, 9))), reverse=True)
        low, best = binpack.bound(np.bincount(lengths, minlength=window + 1), window), fewest(lengths, window)
        assert -(-sum(lengths) // window) <= low <= best
        tight += low == best
    assert tight > 130
    # Plain sums need 2 windows; the functions see that no two of these share one, and that of 7s only two do.
    assert binpack.bound(np.bincount([11, 11, 11], minlength=21), 20) == 3
    assert binpack.bound(np.bincount([7] * 6 + [1], minlength=21), 20) == 3
    assert binpack.bound(np.zeros(21, int), 20) == 0


def windows(spark, lengths, window, block):
    rows = spark.createDataFrame([(k, int(n)) for k, n in enumerate(lengths)], "row long, length long")
    placed, used, least = binpack.place(rows, window, block)
    got = placed.collect()
    assert sorted(x["row"] for x in got) == list(range(len(lengths)))
    inside = defaultdict(list)
    for x in got:
        inside[x["sequence_id"]].append((x["offset"], int(lengths[x["row"]])))
    for found in inside.values():
        at = 0
        for o, n in sorted(found):
            assert o == at
            at += n
        assert at <= window
    assert used == len(inside) >= least == binpack.bound(np.bincount(lengths, minlength=window + 1), window)
    return used


def test_exchange_closes_gaps(spark):
    r = np.random.default_rng(3)
    lengths = r.integers(300, 1200, 3000)
    alone = len(binpack.best_fit(np.sort(lengths)[::-1], 2048)[2])
    parts = sum(len(binpack.best_fit(np.sort(lengths[k::10])[::-1], 2048)[2]) for k in range(10))
    got = windows(spark, lengths, 2048, 300)
    assert got < parts - 3 and got <= alone + 2
    small = r.integers(1, 400, 4000)
    assert windows(spark, small, 2048, 250) <= -(-int(small.sum()) // 2048) + 1
    assert windows(spark, np.array([2047, 2047, 1, 1]), 2048, 1) == 2


def test_ids_equal_the_library(vocabulary, library):
    texts = [t for _, t, *_ in edge_rows()] + ODD + ["H̱ ẖ H h", "J̌ ǰ", "a\x0bb\x0cc\rd", "<|endoftext|> <|ENDOFTEXT|>"]
    for most in (1 << 20, 64):
        known = wordids.WordIds(vocabulary, most)
        for _ in range(2):
            ids, bounds = known.of(pa.array(texts, pa.string()))
            assert [ids[bounds[k]:bounds[k + 1]].tolist() for k in range(len(texts))] == [library(t) for t in texts]


def test_round_trip(spark, library, clashing, nothing):
    data = edge_rows() + [(700 + k, t, "en", "s", 1) for k, t in enumerate(ODD)]
    got = binpack.op13(spark.createDataFrame(data, SCHEMA), vocabulary_path())
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = got.toPandas()
    want = Counter()
    for d, t, *_ in data:
        ids = np.array([*library(t), 0], dtype="<u4")
        for k in range(0, len(ids), 2048):
            want[(d, k // 2048, k, len(ids[k:k + 2048]), zlib.crc32(ids[k:k + 2048].tobytes()))] += 1
    none = lambda x: None if x != x else int(x)
    have = Counter((none(p.doc_id), p.piece, p.start, p.length, p.ids_crc32) for p in got.itertuples())
    assert have == want
    for _, w in got.sort_values("offset").groupby("sequence_id"):
        assert (w["offset"].to_numpy() == np.r_[0, w["length"].cumsum().to_numpy()[:-1]]).all() and w["length"].sum() <= 2048
    assert got["sequence_id"].nunique() == -(-int(got["length"].sum()) // 2048)
    assert binpack.op13(clashing, vocabulary_path()).count() == sum(-(-(len(library(t)) + 1) // 2048) for _, t, *_ in edge_rows())
    assert binpack.op13(nothing, vocabulary_path()).count() == 0
