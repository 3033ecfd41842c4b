"""J5 for keyword tables of any size: a substring join filtered by character grams.

A text that contains a keyword contains all of its grams, so it is enough to ask
for one. Each keyword's key is the one of its trigrams that the fewest texts
hold (a keyword shorter than three characters is its own key); a text's
distinct grams meet the keys by an equi-join, and ``contains`` verifies what met. A
keyword has one key and a text each gram once, so no pair is found twice.

Two ways, with equal results:

* The keys and their keywords are small enough to be broadcast (checked): each
  text's grams are looked up in its row, as numbers, by portions of an Arrow
  batch; a text is never copied per gram, nothing of the texts is shuffled.
* Otherwise texts are written with a row number; only (gram, number) is shuffled,
  by a join that spreads hot grams, and the texts are met again to verify.

Defined results: null texts and null keywords match nothing, an empty keyword
every text that isn't null; repeated rows give hits each; a keyword with several
aspects gives one hit for each; an empty lexicon gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.operators.base import NumberTable, join_hot, portions
from opinari.session import scratch_path

GRAM = 3
#: Rows (gram, or key with its keywords) that may be broadcast.
MAX_BROADCAST = 300_000


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _sized(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def grams(text: Column, sizes=(GRAM,)) -> Column:
    """The distinct substrings of the given sizes; one linear pass each."""
    found = [F.array(F.lit("")) if n == 0 else F.regexp_extract_all(text, F.lit("(?s)(?=(.{%d}))" % n), F.lit(1)) for n in sizes]
    return F.array_distinct(F.concat(*found)) if len(found) > 1 else F.array_distinct(found[0])


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after the other, and the index of each one's text."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    return points, np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])


def _gram_numbers(points: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(gram, whether it lies in one text) from every place on. A gram is a number: up to three code points of 21 bits, so
    no two share one."""
    n = max(len(points) - size + 1, 0)
    numbers = points[:n]
    for k in range(1, size):
        numbers = numbers << 21 | points[k:n + k]
    return numbers, row[:n] == row[size - 1:]


Tables = dict[int, tuple[NumberTable, np.ndarray]]


def _tables(grams_: list[str]) -> Tables:
    """By size: a table of the grams' numbers, and which gram each is."""
    out = {}
    for size in sorted({len(g) for g in grams_}):
        which = np.array([k for k, g in enumerate(grams_) if len(g) == size])
        numbers = _gram_numbers(*_points([grams_[k] for k in which]), size)[0][::size] if size else np.zeros(0, np.int64)
        out[size] = NumberTable(numbers), which
    return out


def _places(points: np.ndarray, row: np.ndarray, tables: Tables) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place, gram) where a gram of a table begins, by size from 1."""
    for size, (table, which) in tables.items():
        if size:
            numbers, inside = _gram_numbers(points, row, size)
            found = table.places(numbers)
            at = np.flatnonzero((found >= 0) & inside)
            yield at, which[found[at]]


def _texts_of(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in batches:
        for at, n in portions(pc.binary_length(batch.column(column)), 1 << 18):
            yield (part := batch.slice(at, n)), part.column(column).to_pylist()


def _text_counts(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(gram, texts): how many of ``texts (low)`` hold each gram of ``asked``, which is broadcast."""
    grams_ = [r[0] for r in asked.collect()]                  # at most MAX_BROADCAST
    shared = texts.sparkSession.sparkContext.broadcast((grams_, _tables(grams_)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tables = shared.value
        total = np.zeros(len(names), np.int64)
        for _, lows in _texts_of(batches, 0):
            points, row = _points(lows)
            for at, gram in _places(points, row, tables):
                pairs = np.unique(row[at].astype(np.int64) * len(names) + gram)
                total += np.bincount(pairs % len(names), minlength=len(names))
            if 0 in tables:
                total[tables[0][1][0]] += len(lows)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()).take(pa.array(held)), pa.array(total[held])], names=["gram", "texts"])

    return texts.select("low").mapInArrow(run, "gram string, texts long").groupBy("gram").agg(F.sum("texts").alias("texts"))


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


_MULT = 0x9E3779B97F4A7C15


class _Finder:
    """The keywords of a sorted posting (gram, keyword, aspect), found in portions of texts: where a keyword's key stands,
    a hash of the text around it is compared, and what agrees is confirmed by ``in``."""

    def __init__(self, rows: pa.Table):
        gram, self.aspects, keyword = (rows.column(c).to_pylist() for c in ("gram", "aspect", "keyword"))
        # A gram's keywords, and a keyword's aspects, are neighbours.
        first = [k for k in range(len(gram)) if k == 0 or (gram[k], keyword[k]) != (gram[k - 1], keyword[k - 1])]
        self.word = [keyword[k] for k in first]
        self.aspects_from, self.aspects_n = np.array(first), np.diff([*first, len(gram)])
        key = [gram[k] for k in first]
        start = [k for k in range(len(key)) if k == 0 or key[k] != key[k - 1]]
        self.words_from, self.words_n = np.array(start), np.diff([*start, len(key)])
        self.tables = _tables([key[k] for k in start])
        self.length = np.array([len(w) for w in self.word])
        self.before = np.array([w.find(g) for w, g in zip(self.word, key)])          # characters before the key
        ends = np.cumsum(self.length)
        total = self._sums(_points(self.word)[0])
        self.hash = self._of(total, ends - self.length, ends)

    @staticmethod
    def _sums(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = np.full(len(points) + 1, _MULT, np.uint64)
        steps[0] = 1
        up = np.multiply.accumulate(steps)[:-1]
        steps[1:] = pow(_MULT, -1, 1 << 64)
        return np.r_[np.uint64(0), np.cumsum((points.astype(np.uint64) + np.uint64(1)) * up)], np.multiply.accumulate(steps)

    @staticmethod
    def _of(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[0][end] - sums[0][start]) * sums[1][start]

    def find(self, lows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, row of the posting) of every hit."""
        points, row = _points(lows)
        sums, words = self._sums(points), len(self.word)
        found = [np.zeros(0, np.int64)]
        if 0 in self.tables:                                                          # the empty keyword
            found.append(np.arange(len(lows)) * words + self.words_from[self.tables[0][1][0]])
        for at, gram in _places(points, row, self.tables):
            n = self.words_n[gram]
            word = _ranges(self.words_from[gram], n)
            start = np.repeat(at, n) - self.before[word]
            end = start + self.length[word]
            fits = (start >= 0) & (end <= len(points))
            word, start, end = word[fits], start[fits], end[fits]
            agree = (row[start] == row[end - 1]) & (self._of(sums, start, end) == self.hash[word])
            found.append(np.unique(row[start[agree]].astype(np.int64) * words + word[agree]))
        pairs = np.concatenate(found)
        text, word = pairs // words, pairs % words
        good = self.length[word] <= GRAM
        unsure = np.flatnonzero(~good)
        good[unsure] = [self.word[k] in lows[t] for t, k in zip(text[unsure].tolist(), word[unsure].tolist())]
        text, word = text[good], word[good]
        return np.repeat(text, self.aspects_n[word]), _ranges(self.aspects_from[word], self.aspects_n[word])


#: Hits that leave a task at once.
HITS = 1 << 16


def _hits_in_rows(texts: DataFrame, posting: DataFrame) -> DataFrame:
    """(id, aspect, keyword) of ``texts (id, low)`` from a broadcast posting (gram, words)."""
    rows = posting.select("gram", F.explode("words").alias("w")).select("gram", "w.aspect", "w.keyword") \
        .orderBy("gram", "keyword", "aspect").toArrow().combine_chunks()              # at most MAX_BROADCAST
    shared = texts.sparkSession.sparkContext.broadcast(rows)
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not shared.value.num_rows:
            return
        finder = _Finder(shared.value)
        aspects, keywords = (shared.value.column(c).combine_chunks() for c in ("aspect", "keyword"))
        for part, lows in _texts_of(batches, 1):
            text, at = finder.find(lows)
            for lo in range(0, len(at), HITS):
                which = pa.array(at[lo:lo + HITS])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(text[lo:lo + HITS])), aspects.take(which), keywords.take(which)],
                                                 names=["id", "aspect", "keyword"])

    return texts.select("id", "low").mapInArrow(run, f"id {kind}, aspect string, keyword string")


def _own_grams(keyword: Column) -> Column:
    return F.when(F.length(keyword) < GRAM, F.array(keyword)).otherwise(grams(keyword))


def keyword_keys(texts: DataFrame, words: DataFrame, sizes: list[int]) -> DataFrame:
    """(keyword, gram, texts): every keyword of ``words`` whose grams all occur in ``texts (low)``, with the rarest one
    and the number of texts that hold it."""
    own = _written(words.select("keyword", F.explode(_own_grams(F.col("keyword"))).alias("gram")), "keyword-grams")
    asked = _written(own.select("gram").distinct(), "asked-grams")
    if asked.count() <= MAX_BROADCAST:
        held = _text_counts(texts, asked)
    else:
        # A text gives each gram once; counted before the shuffle.
        held = texts.select(F.explode(grams(F.col("low"), sizes)).alias("gram")).join(asked, "gram", "left_semi") \
            .groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))
    held = _sized(_written(held, "gram-counts"))
    ranked = own.join(held, "gram", "left").groupBy("keyword").agg(
        F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "gram")).alias("k"))
    return ranked.where("k.texts > 0").select("keyword", "k.gram", "k.texts")


def gram_hits(df: DataFrame, lexicon_df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, aspect, keyword) for every row of ``df`` whose lower-cased text contains the keyword, for
    each distinct ``(aspect, keyword)`` of ``lexicon_df``."""
    texts = df.select(F.col(id_col).alias("id"), F.lower(F.col(text_col)).alias("low")).where("low is not null")
    lexicon = _written(lexicon_df.select("aspect", "keyword").where("keyword is not null").distinct(), "lexicon")
    sizes = [r[0] for r in lexicon.select(F.least(F.length("keyword"), F.lit(GRAM))).distinct().collect()]   # at most 0..3
    if not sizes:
        return texts.limit(0).select(F.col("id").alias(id_col), F.lit("").alias("aspect"), F.lit("").alias("keyword"))
    keys = _written(keyword_keys(texts, lexicon.select("keyword").distinct(), sizes), "keyword-keys")
    posting = keys.join(lexicon, "keyword").groupBy("gram").agg(
        F.max("texts").alias("texts"), F.collect_list(F.struct("aspect", "keyword")).alias("words"))
    posting = _written(posting, "postings")
    rows, words = posting.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    out = [F.col("id").alias(id_col), F.col("w.aspect").alias("aspect"), F.col("w.keyword").alias("keyword")]
    if max(rows, words) <= MAX_BROADCAST:
        return _hits_in_rows(texts, posting).select(F.col("id").alias(id_col), "aspect", "keyword")
    numbered = _written(texts.withColumn("row", F.monotonically_increasing_id()), "texts")
    asked = numbered.select("row", F.explode(grams(F.col("low"), sizes)).alias("gram")) \
        .join(_sized(posting.select("gram")), "gram", "left_semi")
    total = posting.agg(F.sum("texts")).first()[0]
    met = join_hot(asked, posting, "gram", "texts", total, "inner").select("row", F.explode("words").alias("w"))
    return met.join(numbered, "row").where(F.col("low").contains(F.col("w.keyword"))).select(*out)
