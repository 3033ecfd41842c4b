"""Language-model scores by stupid backoff over word pairs (order 2), computed relationally.

Counts cover every word and every pair of the corpus; a document is scored by what
the other documents hold, so its own occurrences are taken off.

1. Word counts over the whole corpus. The ``size`` most frequent words get a number
   and travel as a broadcast table with their counts: they are the hot keys. All
   others keep their 64-bit hash and their counts stay in a distributed table.
2. Pair counts over the whole corpus, summed inside each batch before they are
   shuffled by the hash of the pair. A pair that occurs once has no other document
   and can't be met, so only the rest is kept, which loses nothing. Pairs of two of
   the ``head`` most frequent numbers would be the hot keys of any join; they live
   in a dense ``head`` x ``head`` table, which is small and broadcast.
3. Every document's remaining pairs, one row per distinct pair, and its words without
   a number are joined to the counts by hash and summed per document. Rows that can't
   meet a count stay out of the join: a bitmap of the table's keys, 16 bits a key
   and 16 MB at most, is broadcast. A bit set by another key lets a row through
   in vain, so a full bitmap costs shuffle and no result.

With c the corpus' counts less the document's own and N the words of the other
documents: ``S(w | v) = c(v w) / c(v)`` if c(v w) > 0, else ``backoff * max(c(w), 1) / max(N, 1)``; the
first word has ``max(c(w), 1) / max(N, 1)``.

Defined results: null and empty texts have 0 words, log_prob 0.0 and a null
score; repeated rows are documents of their own; ties for the last numbers all
keep their hash, which changes no result; an empty table gives no rows. Only the
named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinari.llm import words
from opinari.llm.common import HOT_SHARE, written
from opinari.llm.words import mix64

SIZE = 1 << 17        # words whose counts are broadcast (24 bytes each)
HEAD = 1 << 10
BACKOFF = 0.4
KEY_BITS = 16         # of the bitmap, per key of the table
MAX_BITS = 1 << 27
_COUNTED = "pair long, n long, cv long, cw long"
_SHIFT = np.int64(32)
_ALONE = np.uint64(0xA0761D6478BD642F)


@dataclass
class Frequent:
    hashes: np.ndarray      # sorted
    numbers: np.ndarray     # of the words in that order, from 1
    counts: np.ndarray      # by number; 0 stands for all other words
    total: int
    head: int

    def __post_init__(self):
        # Hashes are spread evenly: their first bits tell nearly where they stand. The last entry is beyond all.
        self.bits = max(1, 2 * len(self.hashes)).bit_length()
        self.starts = np.searchsorted(self.hashes, np.arange(1 << self.bits, dtype=np.uint64) << np.uint64(64 - self.bits)).astype(np.int32)
        self.hashes = np.r_[self.hashes, np.uint64((1 << 64) - 1)]
        self.numbers = np.r_[self.numbers, 0]

    def read(self, h: np.ndarray) -> np.ndarray:
        at = self.starts[(h >> np.uint64(64 - self.bits)).view(np.int64)]
        short = np.flatnonzero(self.hashes[at] < h)
        while len(short):
            at[short] += 1
            short = short[self.hashes[at[short]] < h[short]]
        return np.where(self.hashes[at] == h, self.numbers[at], 0)


def _summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(key, n) lists as one, with the n of equal keys added up."""
    key, at = np.unique(np.concatenate([k for k, _ in found]), return_inverse=True)
    return key, np.bincount(at, weights=np.concatenate([n for _, n in found])).astype(np.int64)


def _word_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for portion in words.portions(batch, 0):
            got = [h for _, _, _, h, *_ in words.slices(portion.column(0), words.ALNUM)]
            found.append(np.unique(np.concatenate(got), return_counts=True))
        if found:
            h, n = _summed(found)
            yield from words.parts([h.view(np.int64), n], ["w", "n"])


def word_counts(texts: DataFrame) -> DataFrame:
    """(w, n) of every word of ``texts (text)``, by its hash; written."""
    return written(texts.mapInArrow(_word_sums, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "words")


def frequent(sums: DataFrame, size: int = SIZE, head: int = HEAD) -> Frequent:
    """The most frequent words, at most ``size`` of them."""
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # The least count that leaves at most ``size`` words: a histogram of the counts, from above.
    steps = sums.groupBy("n").agg(F.count(F.lit(1)).alias("m"))
    above = F.sum("m").over(Window.orderBy(F.desc("n")))
    floor = steps.select("n", above.alias("above")).where(F.col("above") <= size).agg(F.min("n")).first()[0]
    if floor is None:
        return Frequent(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(1, np.int64), total, head)
    got = sums.where(F.col("n") >= floor).toPandas()      # at most ``size`` rows
    h, n = got["w"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)
    order = np.lexsort((h, -n))
    number = np.empty(len(h), dtype=np.int64)
    number[order] = np.arange(1, len(h) + 1)
    by_hash = np.argsort(h)
    return Frequent(h[by_hash], number[by_hash], np.r_[0, n[order]], total, head)


def _pair_key(v: np.ndarray, w: np.ndarray, hv: np.ndarray, hw: np.ndarray) -> np.ndarray:
    """Both numbers, or a negative hash of both words if one has none."""
    mixed = (mix64(hv * words.ODD_PAIR + hw) | np.uint64(1 << 63)).view(np.int64)
    return np.where((v > 0) & (w > 0), (v << _SHIFT) | w, mixed)


def _alone_key(h: np.ndarray) -> np.ndarray:
    """Key of a word by itself."""
    return (mix64(h ^ _ALONE) | np.uint64(1 << 63)).view(np.int64)


def _split(f: Frequent, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b = np.maximum(pair, 0) >> _SHIFT, np.maximum(pair, 0) & np.int64((1 << 32) - 1)
    return a, b, (pair > 0) & (a < f.head) & (b < f.head)


def _heads(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, first, count): places by key, and where in that order each distinct key begins and how often it occurs."""
    order = np.argsort(key)
    k = key[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return order, first, np.diff(np.r_[first, len(k)])


def _grouped(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a place, count) of every distinct (key, doc), by place, and for all places the count of theirs."""
    order, first, count = _heads(mix64(key.view(np.uint64)) ^ doc.astype(np.uint64) * words.ODD_PAIR)
    each = np.empty(len(key), dtype=np.int64)
    each[order] = np.repeat(count, count)
    place = np.sort(order[first])
    return place, each[place], each


def _pair_sums(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        dense = np.zeros(f.head * f.head, dtype=np.int64)
        for batch in batches:
            # Beyond the head few pairs repeat inside a batch; Spark's map-side sums take the rest.
            for portion in words.portions(batch, 0):
                keys, vs, ws, ks = [], [], [], []
                for i, j, first, h, *_ in words.slices(portion.column(0), words.ALNUM):
                    doc = np.repeat(np.arange(j - i), np.diff(first))
                    inside = doc[1:] == doc[:-1]
                    n = f.read(h)
                    v, w, hv, hw = n[:-1][inside], n[1:][inside], h[:-1][inside], h[1:][inside]
                    key = _pair_key(v, w, hv, hw)
                    a, b, top = _split(f, key)
                    np.add.at(dense, a[top] * f.head + b[top], 1)
                    keys.append(key[~top])
                    vs.append(np.where(v > 0, 0, hv.view(np.int64))[~top])
                    ws.append(np.where(w > 0, 0, hw.view(np.int64))[~top])
                    ks.append(np.where(key > 0, 0, np.maximum(v, w))[~top])
                if keys:
                    key = np.concatenate(keys)
                    order, first, n = _heads(key)
                    at = order[first]
                    key, v, w, k = (x[at] for x in (key, *map(np.concatenate, (vs, ws, ks))))
                    # Numbers of two are in the key already, that of one is k.
                    yield from words.parts([key, n, pa.array(v, mask=v == 0), pa.array(w, mask=w == 0), pa.array(k, mask=k == 0)],
                                           ["pair", "n", "v", "w", "k"])
        at = np.flatnonzero(dense)
        a, b = np.divmod(at, f.head)
        none = pa.nulls(len(a), pa.int64())
        yield from words.parts([(a << _SHIFT) | b, dense[at], none, none, none], ["pair", "n", "v", "w", "k"])
    return run


def _top(head: int) -> Column:
    """Pairs of the dense table."""
    return (F.col("pair") > 0) & (F.shiftright("pair", 32) < head) & (F.col("pair").bitwiseAND((1 << 32) - 1) < head)


def pair_tables(texts: DataFrame, sums: DataFrame, shared) -> tuple[DataFrame, DataFrame]:
    """(pair, n) of every pair of two numbers in ``texts (text)`` that occurs more than once; and (pair, n, cv, cw) of all other
    such pairs, with the counts of their words, and (pair, n, 0, 0) of every such word without a number. Both written."""
    found = texts.mapInArrow(_pair_sums(shared), "pair long, n long, v long, w long, k long").groupBy("pair") \
        .agg(F.sum("n").alias("n"), F.max("v").alias("v"), F.max("w").alias("w"), F.max("k").alias("k")).where("n > 1")
    found = written(found, "pair_sums")
    # Words without a number are rare, so no key of these joins is hot.
    count = lambda c: sums.select(F.col("w").alias(c), F.col("n").alias(f"c{c}"))
    rare = found.where("pair < 0").join(count("v"), "v", "left").join(count("w"), "w", "left").select("pair", "n", "k", "cv", "cw")

    def other(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The count of the word with a number, if there is one."""
        f = shared.value
        for batch in batches:
            known = pa.array(f.counts[batch.column(2).fill_null(0).to_numpy()])
            cv, cw = (pa.compute.coalesce(batch.column(c), known) for c in (3, 4))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), cv, cw], names=["pair", "n", "cv", "cw"])

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            h, n = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            some = (f.read(h) == 0) & (n > 1)
            zero = pa.array(np.zeros(int(some.sum()), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(_alone_key(h[some])), pa.array(n[some]), zero, zero], names=["pair", "n", "cv", "cw"])

    rare = written(rare.mapInArrow(other, _COUNTED).union(sums.mapInArrow(alone, _COUNTED)), "pairs")
    return found.where("pair > 0").select("pair", "n"), rare


def _word_counts_of(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        for batch in batches:
            pair = batch.column(0).to_numpy()
            cv, cw = f.counts[pair >> _SHIFT], f.counts[pair & np.int64((1 << 32) - 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cv), pa.array(cw)], names=["pair", "n", "cv", "cw"])
    return run


@dataclass
class Held:
    """Which keys a table may hold, by one bit of a key's hash."""
    bitmap: np.ndarray      # bytes, their number a power of two

    def may(self, key: np.ndarray) -> np.ndarray:
        at = _place(key, len(self.bitmap) * 8)
        return (self.bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def _place(key: np.ndarray, bits: int) -> np.ndarray:
    return (mix64(key.view(np.uint64)) & np.uint64(bits - 1)).view(np.int64)


def held_keys(keys: DataFrame, bits: int | None = None) -> Held:
    """The bitmap of ``keys (pair)``; ``bits`` is a power of two from 32,768 on, by default made from the number of keys."""
    if bits is None:
        bits = 1 << 15
        wanted = min(KEY_BITS * keys.count(), MAX_BITS)
        while bits < wanted:
            bits *= 2

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_place(batch.column(0).to_numpy(), bits) + 1)], names=["at"])

    blocks = keys.select("pair").mapInArrow(places, "at long").groupBy(F.bitmap_bucket_number("at").alias("block")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).toPandas()    # bits / 32,768 rows of 4 KB at most
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for block, found in zip(blocks["block"], blocks["bits"]):
        bitmap[(block - 1) * 4096:block * 4096] = np.frombuffer(found, np.uint8)
    return Held(bitmap)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, head: int = HEAD,
          backoff: float = BACKOFF, bits: int | None = None) -> DataFrame:
    """doc_id, n_words, n_backoff (words scored by backing off), log_prob and score (log_prob per word) of every row."""
    texts = docs.select(F.col(text).alias("text"))
    share = docs.sparkSession.sparkContext.broadcast
    sums = word_counts(texts)
    known = share(frequent(sums, size, head))
    numbered, rare = pair_tables(texts, sums, known)
    top = numbered.where(_top(head)).toPandas()       # at most head * head rows
    dense = np.zeros((head, head), dtype=np.int64)
    pair = top["pair"].to_numpy(np.int64)
    dense[pair >> _SHIFT, pair & np.int64((1 << 32) - 1)] = top["n"]
    numbered = numbered.where(~_top(head))
    # Pairs with more than a ten-thousandth of all occurrences: at most HOT_SHARE rows.
    total = numbered.select("n").union(rare.select("n")).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    is_hot = F.col("n") > max(1, total // HOT_SHARE)
    hot = numbered.where(is_hot).orderBy("pair").toPandas()
    dense = share((dense, hot["pair"].to_numpy(np.int64), hot["n"].to_numpy(np.int64)))
    numbered = numbered.where(~is_hot)
    held = share(held_keys(numbered.select("pair").union(rare.select("pair")), bits))
    rest = numbered.mapInArrow(_word_counts_of(known), _COUNTED).union(rare)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, (near, hot_pair, hot_n), table = known.value, dense.value, held.value
        for batch in (p for whole in batches for p in words.portions(whole, 2)):
            m = batch.num_rows
            row = batch.column(0).to_numpy()
            n, base, back = np.zeros(m, np.int64), np.zeros(m), np.zeros(m, np.int64)
            out: list[list[np.ndarray]] = [[] for _ in range(5)]       # owner, key, times, own v (0: a word alone), own w
            for i, j, first, h, *_ in words.slices(batch.column(2), words.ALNUM):
                n[i:j] = np.diff(first)
                if not len(h):
                    continue
                doc = np.repeat(np.arange(j - i), np.diff(first))
                w = f.read(h)
                at, _, mine = _grouped(h.view(np.int64), doc)        # mine: occurrences in the document, of each place
                left = np.where(w > 0, f.counts[w] - mine, -1)       # in others; -1: not known here
                rest = np.log(np.maximum(f.total - n[i:j], 1))
                start = np.zeros(len(h), dtype=bool)
                start[first[:-1][first[:-1] < first[1:]]] = True
                # Everything backs off at first; a word without a number is taken to be in no other document.
                alone = np.where(w > 0, np.log(np.maximum(left, 1)), 0.0) - rest[doc] + np.where(start, 0.0, np.log(backoff))
                base[i:j] += np.bincount(doc, alone, j - i)
                back[i:j] += np.bincount(doc[~start], minlength=j - i)
                # Its count comes by the join.
                some = at[w[at] == 0]
                some = some[table.may(_alone_key(h[some]))]
                for box, x in zip(out, (row[i + doc[some]], _alone_key(h[some]), mine[some], mine[some] * 0, mine[some] * 0)):
                    box.append(x)
                second = np.flatnonzero(~start)
                key = _pair_key(w[second - 1], w[second], h[second - 1], h[second])
                p, times, _ = _grouped(key, doc[second])
                s, key = second[p], key[p]
                a, b, both = _split(f, key)
                place = np.minimum(np.searchsorted(hot_pair, key), max(len(hot_pair) - 1, 0))
                warm = (hot_pair[place] == key) & ~both if len(hot_pair) else np.zeros(len(key), dtype=bool)
                c = near[np.where(both, a, 0), np.where(both, b, 0)]
                c[warm] = hot_n[place[warm]]
                both |= warm
                c = c[both] - times[both]
                hit, s_top, t_top = c > 0, s[both], times[both]
                gain = np.log(np.maximum(c, 1)) - np.log(np.maximum(left[s_top - 1], 1)) - np.log(backoff) \
                    - np.log(np.maximum(left[s_top], 1)) + rest[doc[s_top]]
                base[i:j] += np.bincount(doc[s_top][hit], (t_top * gain)[hit], j - i)
                back[i:j] -= np.bincount(doc[s_top][hit], t_top[hit], j - i).astype(np.int64)
                far = np.flatnonzero(~both)
                far = far[table.may(key[far])]
                s, key, times = s[far], key[far], times[far]
                for box, x in zip(out, (row[i + doc[s]], key, times, mine[s - 1], mine[s])):
                    box.append(x)
            cat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
            k = len(cat[0])
            null = lambda kind: pa.nulls(k, kind)
            zero = np.zeros(m, np.int64)
            small = lambda x: pa.array(np.r_[zero, x].astype(np.int32))
            # A document's own row has a key that no pair has, so it meets nothing.
            yield from words.parts(
                [np.r_[row, cat[0]], np.r_[-1 - row, cat[1]], pa.array(np.r_[back, cat[2]].astype(np.int32)),
                 small(cat[3]), small(cat[4]),
                 pa.concat_arrays([pa.array(n), null(pa.int64())]), pa.concat_arrays([pa.array(base), null(pa.float64())]),
                 pa.concat_arrays([batch.column(1), null(batch.column(1).type)])],
                ["row", "pair", "n", "dv", "dw", "n_words", "base", "doc_id"])

    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.mapInArrow(run, f"row long, pair long, n int, dv int, dw int, n_words long, base double, doc_id {kind}")
    # The table is the smaller side by far: hashed, so that the documents' rows need no sort.
    joined = rows.join(rest.withColumnRenamed("n", "c").hint("shuffle_hash"), "pair", "left")
    others = F.greatest(F.col("c") - F.col("n"), F.lit(0))             # occurrences in other documents
    left = lambda c, d: F.log(F.greatest(F.col(c) - F.col(d), F.lit(1)))
    met = (F.col("dv") > 0) & (others > 0)
    # Of a pair: c(vw) / c(v) in place of backoff * c(w) / N; the document's own log N is added below.
    gain = F.log(F.greatest(others, F.lit(1))) - left("cv", "dv") - left("cw", "dw") - F.log(F.lit(backoff))
    more = F.when(met, gain).when(F.col("dv") == 0, F.log(F.greatest(others, F.lit(1))))
    summed = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.max("base").alias("base"),
        F.sum(F.when(F.col("n_words").isNotNull(), F.col("n"))).alias("back"),
        F.coalesce(F.sum(F.when(met & F.col("n_words").isNull(), F.col("n"))), F.lit(0)).alias("hits"),
        F.coalesce(F.sum(F.when(F.col("n_words").isNull(), F.col("n") * more)), F.lit(0.0)).alias("more"))
    rest_ = F.log(F.greatest(F.lit(known.value.total) - F.col("n_words"), F.lit(1)))
    summed = summed.select("doc_id", "n_words", (F.col("back") - F.col("hits")).alias("n_backoff"),
                           (F.col("base") + F.col("more") + F.col("hits") * rest_).alias("log_prob"))
    return summed.select("doc_id", "n_words", "n_backoff", "log_prob",
                         F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")).alias("score"))
