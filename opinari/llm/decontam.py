"""Benchmark decontamination with a generalised suffix automaton.

Items are word sequences (A-Z as a-z; runs of ASCII letters, digits and
everything beyond ASCII). One automaton holds all of them; document words are
streamed through it and the longest match ending at each word is tracked. An
occurrence is ``window`` consecutive item words, or a whole item that has
fewer.

A pair of neighbouring words that no item holds brings the longest match down
to at most one word, so the automaton is restarted there; numpy finds those
places for all words of a batch at once, and only what lies between them is
walked word by word. That changes no result.

The automaton is built from at most ``SHARD_WORDS`` item words and broadcast:
its states and transitions are under two and three times that number. More
item words are dealt into several automata by hash of the item, built and
applied one after the other; results are then merged per document.

Defined results: null and empty texts have no words and are not contaminated;
items without words are never found; items with equal words count one by one;
an item id null or repeated counts as one id; an empty benchmark hits
nothing; an empty documents table gives no rows. Only the named columns are
read; extra columns of ``docs`` pass through :func:`remove_spans` untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinari.llm import words
from opinari.llm.common import fresh, written

WINDOW = 10
#: Item words in one automaton (about 400 bytes each in memory, so 80 MB).
SHARD_WORDS = 200_000


class Automaton:
    """Generalised suffix automaton over word hashes.

    ``hits(state, longest)`` gives the length of the longest occurrence that
    ends at a state reached with a match of ``longest`` words, and the items
    of all occurrences ending there."""

    def __init__(self, items: list[tuple[int, np.ndarray]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, w in items:
            last = 0
            for x in w.tolist():
                last = self._extend(last, x)
        self._mark(items)
        grams = [w[:-1] * words.ODD_PAIR + w[1:] for _, w in items if len(w) > 1]
        self.pairs = np.unique(words.mix64(np.concatenate(grams))) if grams else np.zeros(0, np.uint64)
        self.singles = np.unique(np.array([w[0] for _, w in items if len(w) == 1], dtype=np.uint64))
        self.cache: dict[tuple[int, int], tuple[int, frozenset]] = {}

    def _clone(self, p: int, x: int, q: int) -> int:
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        c = len(self.next) - 1
        while p >= 0 and self.next[p].get(x) == q:
            self.next[p][x] = c
            p = self.link[p]
        self.link[q] = c
        return c

    def _extend(self, last: int, x: int) -> int:
        q = self.next[last].get(x)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, x, q)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        cur, p = len(self.next) - 1, last
        while p >= 0 and x not in self.next[p]:
            self.next[p][x] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][x]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, x, q)
        return cur

    def _mark(self, items) -> None:
        """Occurrences per state: (length, item) where an occurrence of that
        length of the item is among the state's strings."""
        self.marks: dict[int, set[tuple[int, int]]] = {}
        for item, w in items:
            size = min(self.window, len(w))
            state = longest = 0
            for x in w.tolist():
                state, longest = self.step(state, longest, x)
                if longest >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    self.marks.setdefault(at, set()).add((size, item))

    def step(self, state: int, longest: int, x: int) -> tuple[int, int]:
        to = self.next[state].get(x)
        while to is None:
            state = self.link[state]
            if state < 0:
                return 0, 0
            longest = self.length[state]
            to = self.next[state].get(x)
        return to, longest + 1

    def hits(self, state: int, longest: int) -> tuple[int, frozenset]:
        key = (state, min(longest, self.window))
        if key not in self.cache:
            found = set()
            at = state
            while at > 0:
                found |= {m for m in self.marks.get(at, ()) if m[0] <= longest}
                at = self.link[at]
            if len(self.cache) > 1_000_000:
                self.cache.clear()
            self.cache[key] = (max((n for n, _ in found), default=0), frozenset(i for _, i in found))
        return self.cache[key]

    def stream(self, w: np.ndarray, at: int) -> tuple[list[tuple[int, int]], set]:
        """Hit word spans (merged, ends exclusive) and found items in ``w``, whose first
        word is number ``at``."""
        spans, found, state, longest = [], set(), 0, 0
        for k, x in enumerate(w.tolist(), at + 1):
            state, longest = self.step(state, longest, x)
            size, items = self.hits(state, longest) if longest else (0, ())
            if size:
                found.update(items)
                lo = k - size
                while spans and lo <= spans[-1][1]:
                    lo = min(lo, spans.pop()[0])
                spans.append((lo, k))
        return spans, found

    def scan(self, first: np.ndarray, h: np.ndarray) -> Iterator[tuple[int, list, set]]:
        """``(document, spans, items)`` for the documents of one slice that hold an occurrence."""
        if not len(h):
            return
        joined = np.zeros(len(h), dtype=bool)       # word k goes on from word k - 1
        if len(self.pairs):
            pair = words.mix64(h[:-1] * words.ODD_PAIR + h[1:])
            joined[1:] = _isin(pair, self.pairs)
        joined[first[:-1][first[:-1] < len(h)]] = False
        lone = _isin(h, self.singles) if len(self.singles) else np.zeros(len(h), dtype=bool)
        begin = np.flatnonzero(~joined)
        size = np.diff(np.r_[begin, len(h)])
        run = (size > 1) | lone[begin]
        doc_of = np.searchsorted(first, begin[run], side="right") - 1
        out: dict[int, tuple[list, set]] = {}
        for lo, n, d in zip(begin[run].tolist(), size[run].tolist(), doc_of.tolist()):
            if n < self.least:
                continue
            spans, found = self.stream(h[lo:lo + n], lo - int(first[d]))
            if spans:
                got = out.setdefault(d, ([], set()))
                got[0].extend(spans)
                got[1].update(found)
        for d, (spans, found) in out.items():
            yield d, spans, found

    @property
    def least(self) -> int:
        """The shortest occurrence there can be."""
        if not hasattr(self, "_least"):
            self._least = min((n for m in self.marks.values() for n, _ in m), default=1 << 60)
        return self._least


def _isin(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.searchsorted(table, x)
    at[at == len(table)] = 0
    return table[at] == x


def _items(benchmark: DataFrame, item_id: str, text: str, window: int, most: int):
    """Word hashes of the items with words: (item as string, words). An item above
    ``most`` words comes in pieces that overlap by ``window - 1`` words, each of
    them at least a window long."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            rows, got = [], []
            for i, j, first, h, *_ in words.slices(batch.column(1), words.ALNUM):
                for k in range(i, j):
                    w = h[first[k - i]:first[k - i + 1]]
                    for at in range(0, max(len(w) - window + 1, min(len(w), 1)), most - window + 1):
                        rows.append(k)
                        got.append(w[at:at + most].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(got, pa.binary())], names=["item", "words"])

    return rows.mapInArrow(run, "item string, words binary")


def automata(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
             window: int = WINDOW, shard_words: int = SHARD_WORDS) -> Iterator[Automaton]:
    """Automata of about ``shard_words`` item words each, one at a time."""
    items = written(_items(benchmark, item_id, text, window, max(shard_words // 4, 2 * window)), "items")
    total = (items.agg(F.sum(F.length("words") / 8)).first()[0]) or 0
    shards = max(1, -(-int(total) // shard_words))
    for k in range(shards if total else 0):
        part = items.where(F.pmod(F.xxhash64("item", "words"), F.lit(shards)) == k)
        got = [(r[0], np.frombuffer(bytes(r[1]), dtype=np.uint64)) for r in part.toLocalIterator()]
        if got:
            yield Automaton(got, window)


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
            window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, n_words, spans (hit words as array of [start, end), merged) and items
    (sorted, distinct) for every row of ``docs``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    shape = T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()),
                          T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
                          T.StructField("items", T.ArrayType(T.StringType()))])
    share = rows.sparkSession.sparkContext.broadcast
    found = [share(a) for a in automata(benchmark, window=window, shard_words=shard_words)] \
        or [share(Automaton([], window))]
    if len(found) == 1:
        return rows.mapInArrow(_matcher(found[0]), shape)
    # Several automata: one pass each over rows with a number of their own, merged per row.
    numbered = written(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")
    parts = None
    for b in found:
        part = numbered.mapInArrow(_matcher(b, "row"), T.StructType([T.StructField("row", T.LongType()), *shape.fields]))
        parts = part if parts is None else parts.union(part)
    merged = parts.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return merged.select("doc_id", "n_words", _merge_spans("spans").alias("spans"), "items")


def _merge_spans(name: str):
    """Union of [start, end) spans as merged, sorted spans."""
    joined = F.aggregate(
        F.array_sort(name), F.array().cast("array<array<bigint>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)[1] >= x[0]),
                              F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1),
                                       F.array(F.array(F.element_at(acc, -1)[0],
                                                       F.greatest(F.element_at(acc, -1)[1], x[1])))))
        .otherwise(F.concat(acc, F.array(x))))
    return joined


def _matcher(shared, row: str | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in (p for whole in batches for p in words.portions(whole, 1)):
            m = batch.num_rows
            n, spans, items = np.zeros(m, np.int64), [[] for _ in range(m)], [[] for _ in range(m)]
            for i, j, first, h, *_ in words.slices(batch.column(1), words.ALNUM):
                n[i:j] = np.diff(first)
                for d, got, found in automaton.scan(first, h):
                    spans[i + d], items[i + d] = [list(s) for s in got], sorted(map(str, found))
            columns = [batch.column(0), pa.array(n), pa.array(spans, pa.list_(pa.list_(pa.int64()))),
                       pa.array(items, pa.list_(pa.string()))]
            names = ["doc_id", "n_words", "spans", "items"]
            if row:
                columns, names = [batch.column(2), *columns], [row, *names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    m = matches(docs, benchmark)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s[1] - s[0])
    return m.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", max_coverage: float = 0.5,
                 window: int = WINDOW, length: str | None = None, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without the texts' benchmark spans: every hit word goes, with the
    characters between the hit words; a document of which more than
    ``max_coverage`` of the words are hit is dropped. ``length`` names a column that
    holds the text's length and follows it. Untouched documents stay as they are,
    byte for byte. Several automata all look at the original text; their spans are
    merged before anything is cut, so ``shard_words`` changes no result."""
    at = docs.columns.index(text), docs.columns.index(length) if length else None
    share = docs.sparkSession.sparkContext.broadcast
    found = [share(a) for a in automata(benchmark, window=window, shard_words=shard_words)]
    if not found:
        return docs
    if len(found) == 1:
        return docs.mapInArrow(_remover(found[0], at, max_coverage), docs.schema)
    row, spans = fresh(docs, "_row"), fresh(docs, "_spans")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    looked = numbered.select(F.lit(None).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(row).alias("row"))
    shape = "row long, doc_id long, n_words long, spans array<array<long>>, items array<string>"
    parts = None
    for b in found:
        part = looked.mapInArrow(_matcher(b, "row"), shape).where(F.size("spans") > 0).select("row", "spans")
        parts = part if parts is None else parts.union(part)
    merged = parts.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans")) \
        .select(F.col("row").alias(row), _merge_spans("spans").alias(spans))
    joined = numbered.join(merged, row, "left").select(*[numbered[c] for c in docs.columns], spans)
    return joined.mapInArrow(_remover(None, at, max_coverage), docs.schema)


def _given(column: pa.Array, i: int, first: np.ndarray) -> Iterator[tuple[int, list, None]]:
    """What ``scan`` yields, from a column of merged spans."""
    for d, spans in enumerate(column.slice(i, len(first) - 1).to_pylist()):
        if spans:
            yield d, spans, None


def _remover(shared, where: tuple[int, int | None], max_coverage: float):
    """Cuts what the automaton finds or, without one, the spans in the last column, which goes."""
    at, sized = where

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in words.portions(whole, at)):     # a slice is all that is made anew
            column = batch.column(at)
            raw, bounds = words.buffers(column)
            changed: dict[int, str | None] = {}
            for i, _, first, h, start, end, base in words.slices(column, words.ALNUM):
                for d, spans, _ in shared.value.scan(first, h) if shared else _given(batch.column(batch.num_columns - 1), i, first):
                    lo = int(first[d])
                    if sum(b - a for a, b in spans) > max_coverage * (int(first[d + 1]) - lo):
                        changed[i + d] = None
                        continue
                    kept, done, before = [], int(bounds[i + d]), None
                    for a, b in spans:
                        if a != before:                  # what is between neighbouring spans goes, too
                            kept.append(raw[done:base + int(start[lo + a])].tobytes())
                        before = b
                        done = base + int(end[lo + b - 1])
                    kept.append(raw[done:int(bounds[i + d + 1])].tobytes())
                    changed[i + d] = b"".join(kept).decode("utf-8", "replace")
            if changed:
                texts = column.to_pylist()
                for k, v in changed.items():
                    texts[k] = v
                columns = list(batch.columns)
                columns[at] = pa.array(texts, column.type)
                if sized is not None:
                    n = columns[sized].to_pylist()
                    for k, v in changed.items():
                        n[k] = len(v or "")
                    columns[sized] = pa.array(n, columns[sized].type)
                batch = pa.RecordBatch.from_arrays(columns, names=batch.schema.names)
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[[k for k, v in changed.items() if v is None]] = False
                batch = batch.filter(pa.array(keep))
            yield batch if shared else batch.select(list(range(batch.num_columns - 1)))

    return run
