"""Spelling variants: words one edit apart, found by blocked Gram matrices.

1. Words and their counts: one explode, one aggregate with a map-side part.
2. Blocks: a word's letters are cut into ``GROUPS`` groups by a fixed rule (code
   point modulo ``GROUPS``); the numbers of letters in each group are the word's
   block, and their sum is its length. One edit moves one letter between two
   groups, or adds or takes one letter of one group: so only blocks whose numbers
   differ by that can hold near words, all of the same or the next length.
   Every word goes to its own block and to those that are below its own in that
   order, ``1 + GROUPS * (GROUPS - 1) / 2 + GROUPS`` rows.
3. A block's words become rows of letter counts; one NumPy product of two such
   matrices gives all squared distances ``|a|^2 + |b|^2 - 2ab``. A replaced letter
   gives at most 2, an added one exactly 1. Those pairs alone are verified: equal
   lengths by the places that differ, others by common prefix and suffix.
   Blocks above ``TILE`` words are cut into slices, each pair of which is a task.
4. Per word the number of near words and the most frequent one are merged from
   the blocks; roots follow by pointer doubling. A form is at least twice as
   frequent as its word, so there are no circles, and at most
   ``log2(most frequent / least)`` steps.

The products grow with the square of a block, so the number of groups grows with
the words: ``groups`` by default keeps an average block small (see
:func:`group_count`).

Defined results: null and empty texts have no words; repeated rows count each;
a row without an id keeps its words as they are; ties go to the smaller word
in code-point order; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.llm.common import written
from opinari.llm.words import mix64
from opinari.operators.base import with_columns_once

TILE = 4096          # words of a block that are multiplied with each other at once
BYTES = 1 << 23      # and letters, for long words
BLOCKS = 200_000     # blocks whose numbers of slices may be broadcast (16 bytes each)


def group_count(words: int) -> int:
    """4 groups up to a million words, one more for every fourfold number."""
    n, groups = 1_000_000, 4
    while words > n:
        n, groups = n * 4, groups + 1
    return groups


def word_counts(docs: DataFrame, changed, doc_id: str = "doc_id", text: str = "text", length: int = 5, least: int = 3) -> DataFrame:
    """(word, n) of the maximal runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased, after ``changed(id, word)``,
    with at least ``length`` letters and ``least`` occurrences. ``changed`` must not lengthen a word."""
    run = F.regexp_extract_all(text, F.lit("[A-Za-zÀ-ÿ]{%d,}" % length), F.lit(0))
    words = docs.select(F.col(doc_id).alias("id"), F.explode(run).alias("w"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    low = F.when(F.col("w").rlike("[A-Z]"), F.translate("w", upper, upper.lower())).otherwise(F.col("w"))
    words = with_columns_once(words, low=low).select("id", "low")
    words = with_columns_once(words, word=changed(F.col("id"), F.col("low")))
    return words.where(F.length("word") >= length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte a letter (all are below U+0100) and the words' bounds."""
    words = column.to_pylist()
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8), np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)


def _key(numbers: np.ndarray) -> np.ndarray:
    """Block key: a hash of the groups' numbers."""
    odd = mix64(np.arange(1, numbers.shape[1] + 1, dtype=np.uint64)) | np.uint64(1)
    return mix64((numbers.astype(np.uint64) * odd).sum(axis=1)).view(np.int64)


def _dealt(groups: int):
    """(block, own, word, n): a word with its own block and those below it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, bounds = _letters(batch.column(0))
            m = batch.num_rows
            if not m:
                continue
            word = np.repeat(np.arange(m), np.diff(bounds))
            numbers = np.bincount(word * groups + letters % groups, minlength=m * groups).reshape(m, groups)
            sent = [(np.arange(m), _key(numbers))]
            for g in range(groups):                       # the block without a letter of g
                some = np.flatnonzero(numbers[:, g])
                less = numbers[some]
                less[:, g] -= 1
                sent.append((some, _key(less)))
            for g, h in combinations(range(groups), 2):   # a letter of g in place of one of h
                some = np.flatnonzero(numbers[:, g])
                other = numbers[some]
                other[:, g] -= 1
                other[:, h] += 1
                sent.append((some, _key(other)))
            at = np.concatenate([k for k, _ in sent])
            own = np.arange(len(at)) < m
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([k for _, k in sent])), pa.array(own), *rows.columns],
                                             names=["block", "own", "word", "n"])
    return run


class _Words:
    """Words of one length: their letters, letter counts (exact in the type) and half their squared lengths."""

    def __init__(self, index: np.ndarray, letters: np.ndarray, starts: np.ndarray, length: int):
        self.index, self.length = index, length
        self.letters = letters[starts[index][:, None] + np.arange(length)[None, :]]

    def count(self, alphabet: np.ndarray):
        kind = np.float32 if self.length < 4000 else np.float64
        place = np.searchsorted(alphabet, self.letters)
        rows = np.arange(len(self.index))[:, None] * len(alphabet)
        self.counts = np.bincount((rows + place).ravel(), minlength=len(self.index) * len(alphabet)) \
            .reshape(len(self.index), len(alphabet)).astype(kind)
        self.half = (self.counts * self.counts).sum(axis=1, keepdims=True) / kind(2)


def _near(a: _Words, b: _Words, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the near words of ``a`` and ``b`` (as long, or one letter longer); each pair once if they are the ``same``."""
    alphabet = np.unique(np.r_[a.letters.ravel(), b.letters.ravel()])
    a.count(alphabet)
    b.count(alphabet)
    left, right = [], []
    step = max(1, (1 << 20) // max(1, len(b.index)))
    # ab - |b|^2 / 2 in one product; |a - b|^2 <= d wherever that is at least (|a|^2 - d) / 2.
    x, y = np.hstack([a.counts, np.ones_like(a.half)]), np.hstack([b.counts, -b.half]).T
    least = a.half - a.half.dtype.type(1.0 if a.length == b.length else 0.5)
    for lo in range(0, len(a.index), step):
        close = np.flatnonzero(x[lo:lo + step] @ y >= least[lo:lo + step])
        i, j = np.divmod(close, len(b.index))
        i += lo
        if same:
            i, j = i[i < j], j[i < j]
        for at in range(0, len(i), 1 + BYTES // a.length):
            s, t = i[at:at + 1 + BYTES // a.length], j[at:at + 1 + BYTES // a.length]
            u, v = a.letters[s], b.letters[t]
            if a.length == b.length:
                ok = (u != v).sum(axis=1) == 1
            else:
                head = np.cumprod(u == v[:, :-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
                tail = np.cumprod((u == v[:, 1:])[:, ::-1], axis=1, dtype=np.int8).sum(axis=1, dtype=np.int64)
                ok = head + tail >= a.length
            left.append(a.index[s[ok]])
            right.append(b.index[t[ok]])
    empty = np.zeros(0, dtype=np.int64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


_OUT = "word string, near long, best struct<m: long, form: string>"


def _block(table: pa.Table) -> pa.Table:
    """Per word of one tile: how many near words it has there, and the best (negative count, word)."""
    table = table.combine_chunks()
    column = lambda c: table.column(c).combine_chunks() if table.column(c).num_chunks else pa.array([])
    word, n = column("word"), column("n").to_numpy()
    own, x, y, part = (column(c).to_numpy(zero_copy_only=False) for c in ("own", "x", "y", "part"))
    letters, bounds = _letters(word)
    length = np.diff(bounds)
    short = int(length[own].min()) if own.any() else 0
    i, j = int(x[0]), int(y[0])
    mine = own & (part == i)
    pairs = []
    if mine.any():
        pick = lambda mask: _Words(np.flatnonzero(mask), letters, bounds, int(length[mask][0]))
        left = pick(mine)
        if i == j and mine.sum() > 1:
            pairs.append(_near(left, left, True))
        elif i < j and (own & (part == j)).any():
            pairs.append(_near(left, pick(own & (part == j)), False))
        for size in (short, short + 1):
            other = ~own & (part == j) & (length == size)
            if other.any():
                pairs.append(_near(left, pick(other), False))
    a = np.concatenate([np.zeros(0, np.int64), *[p[0] for p in pairs], *[p[1] for p in pairs]])
    b = np.concatenate([np.zeros(0, np.int64), *[p[1] for p in pairs], *[p[0] for p in pairs]])
    place = np.empty(len(n), dtype=np.int64)              # the words' code-point order
    place[np.argsort(np.array(word.to_pylist(), dtype=object), kind="stable")] = np.arange(len(n))
    order = np.lexsort((place[b], -n[b], a))
    a, b = a[order], b[order]
    head = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else a
    best = pa.StructArray.from_arrays([pa.array(-n[b[head]]), word.take(pa.array(b[head]))], names=["m", "form"])
    return pa.Table.from_arrays([word.take(pa.array(a[head])), pa.array(np.diff(np.r_[head, len(a)])), best],
                                names=["word", "near", "best"])


def near_words(words: DataFrame, groups: int | None = None, tile: int = TILE) -> DataFrame:
    """(word, n_near, form, form_n) of every word of ``words (word, n)`` that has a near word: their number, the most
    frequent one and its count. ``words`` must be a written table, with each word once."""
    groups = groups or group_count(words.count())
    dealt = words.select("word", "n").mapInArrow(_dealt(groups), "block long, own boolean, word string, n long")
    # Letters count, too: one very long word fills a tile.
    weight = F.sum(F.greatest(F.lit(1.0), F.length("word") * F.lit(tile / BYTES)))
    sizes = dealt.groupBy("block").agg(weight.alias("size"), F.max("own").alias("owned")).where("owned")
    sizes = written(sizes.select("block", F.ceil(F.col("size") / tile).cast("long").alias("parts")), "blocks")
    # A broadcast while it is small; above, the same join by a shuffle.
    dealt = dealt.join(F.broadcast(sizes) if sizes.count() <= BLOCKS else sizes, "block")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")))
    # Tile (x, y): own words of slice x with all words of slice y; own ones only if y >= x.
    every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
    right = F.transform(F.when(F.col("own"), F.filter(every, lambda x: x < F.col("part"))).otherwise(every),
                        lambda x: F.struct(x.alias("x"), F.col("part").alias("y")))
    left = F.transform(every, lambda y: F.struct(F.col("part").alias("x"), y.alias("y")))
    met = dealt.withColumn("t", F.explode(F.when(F.col("own"), F.concat(right, left)).otherwise(right)))
    met = met.select("block", "t.x", "t.y", "part", "own", "word", "n")
    found = met.groupBy("block", "x", "y").applyInArrow(_block, _OUT)
    best = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("b"))
    return best.select("word", "n_near", F.col("b.form").alias("form"), (-F.col("b.m")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms (word, form)``: the last word when forms are followed."""
    at = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = written(at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                              F.col("further").isNotNull().alias("moved")), "roots")
        at = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return at


def variants(words: DataFrame, times: int = 2, groups: int | None = None, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words (word, n)``: ``form`` is the near word
    of largest n, if that is at least ``times`` the word's own."""
    words = written(words.select("word", "n"), "words")
    found = words.join(near_words(words, groups, tile), "word", "left")
    up = F.col("form_n") >= times * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                 F.when(up, F.col("form")).alias("form"), F.when(up, F.col("form_n")).alias("form_n")), "variants")
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def one_less(doc_id: Column, word: Column) -> Column:
    """The query's words: where ``h = crc32('<doc_id>:<word>')`` is divisible by 97, without letter ``h % length``."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), word))
    at = (h % F.length(word)).cast("int")
    return F.when(h % 97 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word)


def op11(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n."""
    return variants(word_counts(docs, one_less))
