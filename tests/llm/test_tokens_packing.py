import json
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from opinari.llm import packing, tokens
from opinari.llm.queries import vocabulary_path

from .helpers import SCHEMA, edge_rows, rows

ODD = ["Hé.llo", "it's we'LL", "A1b2", "ǅáb", "ΑΣ ας", "a\u0301 \u0301", "<|endoftext|>x", "<|endoftext|> <|startoftext|>", "İ K", "—q…",
       "\x00\x1c! \x85 \xa0x", "½ 日本語", "ª µ ÿÀ", "\u2003x\u2028y", "ſt ﬁ", "x\r\ny\tz", "don't 'S", "🙂🙂 ok"]


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.load(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary_path())
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def data(spark):
    r = edge_rows() + [(700 + k, t, "en", "s", 1) for k, t in enumerate(ODD)]
    return r, spark.createDataFrame(r, SCHEMA)


def _no_lower(spec):
    spec["normalizer"]["normalizers"].pop()


def _compatibility(spec):
    spec["normalizer"]["normalizers"][0]["type"] = "NFKC"


def _no_normaliser(spec):
    spec["normalizer"] = None


def _own_split(spec):
    spec["pre_tokenizer"]["pretokenizers"][1]["use_regex"] = True


def _prefix(spec):
    spec["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"] = True


def _single_letters(spec):
    split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]
    split["Regex"] = split["Regex"].replace(r"[\p{L}]+", r"[\p{L}]")


def _dropout(spec):
    spec["model"]["dropout"] = 0.1


@pytest.mark.parametrize("change", [_no_lower, _compatibility, _no_normaliser, _own_split, _prefix, _single_letters, _dropout])
def test_other_tokenizers_are_refused(tmp_path, change):
    with open(vocabulary_path(), encoding="utf-8") as f:
        spec = json.load(f)
    change(spec)
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    with pytest.raises(ValueError):
        tokens.load(str(path))


def test_whole_tokens_are_proven(vocabulary, library):
    assert len(vocabulary.whole) > 30_000
    for piece in list(vocabulary.whole)[::997]:
        assert [t.id for t in vocabulary.tokenizer.model.tokenize(piece)] == [vocabulary.whole[piece]]


def test_counts_equal_the_library(data, library, clashing, nothing, edge):
    r, docs = data
    got = sorted(((x["doc_id"], x["n_bytes"], x["n_tokens"], x["over_limit"]) for x in tokens.op1(docs, vocabulary_path()).collect()), key=repr)
    want = sorted(((d, len((t or "").encode()), len(library(t)), len(library(t)) > 2048) for d, t, *_ in r), key=repr)
    assert got == want
    assert rows(tokens.op1(clashing, vocabulary_path())) == rows(tokens.op1(edge, vocabulary_path()))
    assert tokens.op1(nothing, vocabulary_path()).count() == 0


def test_forgetting_changes_nothing(vocabulary):
    small = tokens.Remembered(vocabulary.count, 3)
    assert [small[c] for c in "a bb ccc dddd a bb".split()] == [vocabulary.count(c) for c in "a bb ccc dddd a bb".split()]


def test_packing_round_trip(data, library, vocabulary, clashing, nothing):
    r, docs = data
    got = packing.op9(docs, vocabulary_path()).toPandas()
    texts = {}
    for d, t, *_ in r:
        texts.setdefault(d, []).append(np.array([*library(t), 1], dtype="<u4"))
    assert got["length"].sum() == sum(len(x) for v in texts.values() for x in v)
    for p in got.itertuples():
        d = None if np.isnan(p.doc_id) else int(p.doc_id)
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for x in texts[d])
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert s["length"].sum() <= 2048
        assert (s["offset"].to_numpy() == np.r_[0, np.cumsum(s["length"])[:-1]]).all()
    assert packing.op9(nothing, vocabulary_path()).count() == 0
    assert packing.op9(clashing, vocabulary_path()).count() == len(edge_pieces(library))


def edge_pieces(library):
    return [1 for _, t, *_ in edge_rows() for _ in range(0, len(library(t)) + 1, 2048)]


def test_sequences_hold_the_ids(data, vocabulary, library):
    r, docs = data
    want = sorted(i for _, t, *_ in r for i in [*library(t), 1])
    got = packing.sequences(docs, vocabulary, pad=-1).toPandas()
    assert all(len(x) == 2048 for x in got["ids"])
    assert sorted(i for x in got["ids"] for i in x if i != -1) == want


def test_best_fit_against_plain_search():
    r = np.random.default_rng(5)
    for window in (8, 100, 2048):
        lengths = sorted(r.integers(1, window + 1, 600).tolist(), reverse=True)
        room, want = [], []
        for n in lengths:
            fits = [w for w in range(len(room)) if room[w] >= n]
            if fits:
                least = min(room[w] for w in fits)
                want.append(least)
                w = next(w for w in fits if room[w] == least)
            else:
                want.append(window)
                room.append(window)
                w = len(room) - 1
            room[w] -= n
        number, offset, used = packing.best_fit(lengths, window)
        assert [window - o for o in offset] == want and used == len(room)


def test_blocks_do_not_share_sequences(data, vocabulary):
    _, docs = data
    got = packing.pack(packing.pieces(docs, vocabulary), block=7).toPandas()
    assert got.groupby("sequence_id")["length"].sum().max() <= 2048
    assert got["sequence_id"].max() >= 1 << 32
