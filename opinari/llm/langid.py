"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Features: the text in lower case, every run of non-letters as one blank,
n-grams of 2 to ``orders`` characters (a text begins with a blank) hashed into ``buckets``. Training is one
distributed pass over all labelled rows: each task adds its rows up into one
count vector per language and hands on sparse sums. The log-probability
matrix (``buckets`` x languages, at most ``MAX_LANGS`` languages, so at most
128 MB, for four languages 1 MB) is broadcast, and texts are scored batch by
batch in numpy over the n-grams they hold.

Defined results: null text and text without a letter give ``und`` with score
0.0, as does every text when nothing could be learned from; ties go to the
first language in sorted order; repeated rows get equal rows; an empty table
gives no rows. Rows with a null label teach nothing. Only the named columns
are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinari.llm.common import fresh, written
from opinari.llm.words import mix64

BUCKETS = 1 << 15
ORDERS = 3
MAX_LANGS = 512
UNKNOWN = "und"
_PIECE = 1 << 16      # characters scored at a time


class _Letters:
    """True per code point that is a letter, built once per worker."""

    table: np.ndarray | None = None

    @classmethod
    def get(cls) -> np.ndarray:
        if cls.table is None:
            cls.table = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
        return cls.table


def _features(texts: list[str | None], buckets: int, orders: int) -> Iterator[tuple]:
    """Yield ``(numbers, borders, ids)`` for the n-grams of one length in a piece of
    the batch: text ``numbers[i]`` has the buckets ``ids[borders[i]:borders[i + 1]]``.
    A long text comes in several pieces that overlap by ``orders - 1``
    characters; every text begins with a blank."""
    group, size = [], 0
    for k, t in enumerate(texts):
        t = " " + (t or "").lower()
        if len(t) <= _PIECE:
            group.append((k, t))
            size += len(t)
            if size >= _PIECE:
                yield from _grams(group, 0, buckets, orders)
                group, size = [], 0
        else:
            for at in range(0, len(t), _PIECE):
                skip = min(at, orders - 1)
                yield from _grams([(k, t[at - skip:at + _PIECE])], skip, buckets, orders)
    if group:
        yield from _grams(group, 0, buckets, orders)


def _grams(group, skip, buckets, orders):
    """N-grams by the position where they end; the first ``skip`` characters are
    context that an earlier piece has counted."""
    points = np.frombuffer("".join(t for _, t in group).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    length = np.array([len(t) for _, t in group])
    border = np.r_[0, np.cumsum(length)]
    numbers = np.array([k for k, _ in group])
    letter = _Letters.get()[points]
    code = np.where(letter, points, np.uint32(32)).astype(np.uint64) + np.uint64(1)
    h, some = code, letter
    for n in range(2, orders + 1):
        back = n - 1
        # Hash and letter test of the n-gram ending at i from those of the (n-1)-gram ending at i.
        longer = h.copy()
        longer[back:] += code[:-back] * np.uint64(_ODD[n])
        h = longer
        some = some.copy()
        some[back:] |= letter[:-back]
        use = some.copy()
        for r in range(back):          # n-grams that would begin before their text
            first = border[:-1] + r
            use[first[first < border[1:]]] = False
        use[:skip] = False
        at = np.flatnonzero(use)
        ids = (mix64(h[at]) & np.uint64(buckets - 1)).astype(np.int64)
        yield numbers, np.searchsorted(at, border), ids


#: Odd multipliers, one per position before the last character.
_ODD = [2 * int(x) + 1 for x in mix64(np.arange(1, 17, dtype=np.uint64)) >> np.uint64(2)]


@dataclass
class Model:
    langs: list[str]
    log_prob: np.ndarray     # buckets x langs
    prior: np.ndarray        # langs
    orders: int = ORDERS

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        n, width = len(texts), len(self.langs)
        if not width:
            return [UNKNOWN] * n, np.zeros(n)
        columns = [np.ascontiguousarray(self.log_prob[:, k]) for k in range(width)]
        total = np.zeros((n, width))
        seen = np.zeros(n, dtype=bool)
        for numbers, border, ids in _features(texts, len(self.log_prob), self.orders):
            some = border[1:] > border[:-1]
            if not some.any():
                continue
            begin, owner = border[:-1][some], numbers[some]
            seen[owner] = True
            for k, column in enumerate(columns):
                total[owner, k] += np.add.reduceat(column[ids], begin)
        total += self.prior
        best = total.argmax(axis=1)
        top = 1.0 / np.exp(total - total[np.arange(n), best][:, None]).sum(axis=1)
        return [self.langs[b] if s else UNKNOWN for b, s in zip(best, seen)], np.where(seen, top, 0.0)


def _count(batches: Iterator[pa.RecordBatch], buckets: int, orders: int) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}

    def flush():
        for lang, v in sums.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at - 1, pa.int64()), pa.array(v[at], pa.int64())],
                names=["lang", "bucket", "n"])
        sums.clear()

    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        names = sorted(set(langs))
        number = {x: k for k, x in enumerate(names)}
        lang_of = np.array([number[x] for x in langs], dtype=np.int64)
        for k, name in enumerate(names):
            if name not in sums and len(sums) >= MAX_LANGS:
                yield from flush()
            v = sums.setdefault(name, np.zeros(buckets + 1, dtype=np.int64))
            v[0] += int((lang_of == k).sum())          # bucket -1: rows
        for numbers, border, ids in _features(texts, buckets, orders):
            owner = np.repeat(lang_of[numbers], np.diff(border))
            for k in np.unique(owner):
                v = sums.setdefault(names[k], np.zeros(buckets + 1, dtype=np.int64))
                v[1:] += np.bincount(ids[owner == k], minlength=buckets)
    yield from flush()


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", buckets: int = BUCKETS,
          orders: int = ORDERS, alpha: float = 0.1) -> Model:
    """Learn from every row with a non-null label. ``buckets`` is a power of two.
    More than MAX_LANGS labels raise ValueError (the matrix's size bound)."""
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")) \
        .where(F.col("lang").isNotNull())
    counts = (rows.mapInArrow(lambda it: _count(it, buckets, orders), "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # At most (buckets + 1) * MAX_LANGS rows are read; one label too many shows before.
    counts = written(counts, "langid")
    langs = [r[0] for r in counts.where(F.col("bucket") == -1).select("lang").orderBy("lang")
             .limit(MAX_LANGS + 1).collect()]
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    if not langs:
        return Model([], np.zeros((buckets, 0)), np.zeros(0), orders)
    langs = sorted(langs)
    got: pd.DataFrame = counts.toPandas()
    table = np.zeros((buckets + 1, len(langs)))
    table[got["bucket"].to_numpy() + 1, np.searchsorted(langs, got["lang"].to_numpy().astype(str))] = got["n"]
    grams = table[1:] + alpha
    return Model(langs, np.log(grams / grams.sum(axis=0)), np.log(table[0] / table[0].sum()), orders)


def predict(docs: DataFrame, model: Model, text: str = "text", lang_col: str = "lang_pred",
            score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` with the predicted language and its posterior
    probability in two further columns, named by the caller so that they can
    be kept apart from the table's own."""
    clash = {lang_col.lower(), score_col.lower()} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"docs already has {sorted(clash)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, score = shared.value.score(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, lang_col, score_col])

    schema = T.StructType([*docs.schema.fields, T.StructField(lang_col, T.StringType()),
                           T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """True for the third of the documents (by id) that is never learned from; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def teachers(docs: DataFrame) -> DataFrame:
    """The rows that may teach: labelled, with an id, not held out."""
    return docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out()).select("lang", "text")


def op8(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    out = predict(docs.select("doc_id", "text"), train(teachers(docs)))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def language_stage(docs: DataFrame, min_score: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is known: neither ``und`` nor a best
    posterior below ``min_score``."""
    lang, score = fresh(docs, "_lang_pred"), fresh(docs, "_lang_score")
    out = predict(docs, train(teachers(docs)), lang_col=lang, score_col=score)
    return out.where((F.col(lang) != UNKNOWN) & (F.col(score) >= min_score)).select(*docs.columns)
