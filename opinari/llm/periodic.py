"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), at least ``max(least, times * q)`` words long, that no
neighbouring word extends keeping the period.

1. Words become numbers by a dictionary (equal numbers: equal words). Documents are
   laid end to end, a number of its own after each, so that nothing crosses a
   border, in slices of about ``SLICE`` words of documents of similar length.
2. Periods up to ``SHORT``: every lag is compared over the whole slice.
3. Longer ones by scales ``(P, K]``, ``K = 1.5 P``: rolling hashes of ``K`` words, and those
   that are the least of some ``W = 2 (P + 1) - K + 1`` neighbouring ones. Inside a run
   of a period in the scale the least one of its first window comes again one
   period later, both windows still fit into three periods, and no equal hash
   lies between, as ``K`` words with two such periods would have a smaller one.
   So one pair of neighbouring equal minimizers lies at exactly the period,
   whatever stands around the run.
4. Such a pair is a seed if one period before or after it repeats (by hash); it
   is extended word by word, so what is reported is exact. A stretch whose period is
   a multiple of a smaller one is left to that one.

Nothing is lost but by a collision of 64-bit hashes inside one slice. Work is
linear in the words times the scales, at most ``log1.5`` of the longest document.

Defined results: null and empty texts have no words, no runs and an empty
collapsed text; repeated rows give equal rows; an empty table gives no rows; a
null id stays null. Only the named columns are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinari.llm import words
from opinari.llm.words import mix64

SLICE = 1 << 16      # words worked on at a time
SHORT = 8            # periods that are compared directly
LEAST, TIMES = 24, 3
_BASE = 0x9E3779B97F4A7C15


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for m in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(n, m, dtype=np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


_UP, _DOWN = _powers(SLICE + 64)


def _spread(x: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` (minimum or maximum) of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = of(x[:-size], x[size:])
        size *= 2
    return of(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def _primes(q: int) -> list[int]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return out + [q] * (q > 1)


def _smallest(w: np.ndarray, at: int, q: int) -> bool:
    """Whether the ``q`` words at ``at`` are no power of a shorter word sequence."""
    return not any(np.array_equal(w[at:at + q - q // r], w[at + q // r:at + q]) for r in _primes(q))


def _same(w: np.ndarray, at: int, q: int, step: int) -> int:
    """How many words from ``at`` on, in the direction of ``step``, equal the ones ``q`` later."""
    found, size = 0, 32
    while True:
        if step > 0:
            n = min(size, len(w) - q - at - found)
            lo = at + found
        else:
            n = min(size, at - found + 1)
            lo = at - found - n + 1
        if n <= 0:
            return found
        other = np.flatnonzero(w[lo:lo + n] != w[lo + q:lo + q + n])
        if len(other):
            return found + (int(other[0]) if step > 0 else n - 1 - int(other[-1]))
        found, size = found + n, size * 2


def _direct(w: np.ndarray, q: int, need: int) -> Iterator[tuple[int, int, int]]:
    equal = np.zeros(len(w) - q + 2, dtype=np.int8)
    equal[1:-1] = w[:-q] == w[q:]
    turn = np.flatnonzero(equal[1:] != equal[:-1])
    a, b = turn[::2], turn[1::2]
    for k in np.flatnonzero(b - a >= need).tolist():
        yield int(a[k]), int(b[k]), q


def _seeds(w: np.ndarray, top: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(position, period) of the seeds of each scale; ``top`` is the longest period asked for."""
    up, down = (_UP, _DOWN) if len(w) < len(_UP) else _powers(len(w) + 1)
    total = np.zeros(len(w) + 1, dtype=np.uint64)
    np.cumsum(mix64(w.view(np.uint64) + np.uint64(1)) * up[:len(w)], out=total[1:])

    def block(at, size):
        return (total[at + size] - total[at]) * down[at]

    low = SHORT
    while low < top:
        k = low + low // 2
        width = 2 * (low + 1) - k + 1
        n = len(w) - k + 1
        if n < width:
            return
        h = mix64((total[k:] - total[:-k]) * down[:n])
        least = _spread(h, width, np.minimum)                       # of the window that begins here
        most = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        chosen = np.flatnonzero(_spread(most, width, np.maximum) == h)
        order = np.argsort(h[chosen], kind="stable")
        at, key = chosen[order], h[chosen[order]]
        gap = at[1:] - at[:-1]
        pair = (key[1:] == key[:-1]) & (gap > low) & (gap <= min(k, top))
        at, gap = at[:-1][pair], gap[pair]
        after, before = at + 2 * gap <= len(w), at >= gap
        ok = np.zeros(len(at), dtype=bool)
        here = block(at, gap)                                       # at + gap + k words exist
        ok[after] = here[after] == block(at[after] + gap[after], gap[after])
        ok[before] |= here[before] == block(at[before] - gap[before], gap[before])
        yield at[ok], gap[ok]
        low = k


def _stretches(w: np.ndarray, top: int, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """``(a, b, q)``: words a..b-1 equal those q later, and neither word beside them does."""
    for q in range(1, min(SHORT, top) + 1):
        yield from _direct(w, q, max(least - q, (times - 1) * q))
    for at, gap in _seeds(w, top):
        order = np.lexsort((at, gap))
        at, gap = at[order], gap[order]
        i = 0
        while i < len(at):
            p, q = int(at[i]), int(gap[i])
            right = _same(w, p, q, 1)
            left = _same(w, p - 1, q, -1) if p else 0
            a, b = p - left, p + right
            if b - a >= max(least - q, (times - 1) * q):
                yield a, b, q
            # The next seed of this period behind the stretch, or of the next period.
            j = int(np.searchsorted(gap, q, side="right"))
            i = i + max(1, int(np.searchsorted(at[i:j], max(b, p + 1))))


def runs(w: np.ndarray, longest: int | None = None, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a number sequence, by start, then period. ``times`` must be 3 or
    more; ``longest`` bounds the length of a run that is possible (by default all of ``w``)."""
    if times < 3:
        raise ValueError("runs of less than three periods need not hold two equal minimizers")
    w = np.ascontiguousarray(w, dtype=np.int64)
    longest = len(w) if longest is None else longest
    if longest < least:
        return []
    return sorted((a, b - a + q, q) for a, b, q in set(_stretches(w, longest // times, least, times)) if _smallest(w, a, q))


def _slices(counts: np.ndarray) -> Iterator[list[int]]:
    """Documents of similar length together, about ``SLICE`` words at a time."""
    some, total = [], 0
    for k in np.argsort(counts, kind="stable").tolist():
        if some and (total + counts[k] + 1 > SLICE or counts[k] > 4 * counts[some[0]] + 256):
            yield some
            some, total = [], 0
        some.append(k)
        total += int(counts[k]) + 1
    if some:
        yield some


def _kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Words that no run contains after its first period."""
    step = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        step[start + period] += 1
        step[start + length] -= 1
    return np.cumsum(step[:n]) == 0


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (structs of start, length, period; by start, then period) and collapsed, the
    text's words joined by one space without those that repeat a run's first period."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def work(texts: list[str | None]):
        split = [(t or "").encode().split() for t in texts]
        counts = np.array([len(s) for s in split], dtype=np.int64)
        found: list = [[] for _ in split]
        for part in _slices(counts):
            if counts[part[-1]] < least:
                continue
            number = defaultdict(int)
            number.default_factory = number.__len__
            w, border = [], []
            for k in part:
                w.extend(map(number.__getitem__, split[k]))
                border.append(len(w))
                w.append(-1 - len(border))
            first = np.r_[0, np.array(border[:-1], dtype=np.int64) + 1]
            for start, length, period in runs(np.array(w, dtype=np.int64), int(counts[part[-1]]), least, times):
                k = int(np.searchsorted(first, start, side="right")) - 1
                found[part[k]].append({"start": start - int(first[k]), "length": length, "period": period})
        for s, f in zip(split, found):
            if f:
                keep = _kept(len(s), [tuple(r.values()) for r in f])
                s = [s[i] for i in np.flatnonzero(keep).tolist()]
            yield b" ".join(s)
        yield counts, found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (p for whole in batches for p in words.portions(whole, 1)):
            *collapsed, (counts, found) = work(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts), pa.array(found, pa.list_(_RUN)), pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, "
                           "runs array<struct<start: long, length: long, period: long>>, collapsed string")


def repeated_tail(doc_id: Column, text: Column) -> Column:
    """The text of the query: where ``h = crc32(doc_id)`` is divisible by 10, each word from ``a`` on becomes word
    ``a + (i - a) % p``; ``g = h // 10``, ``a = g % n``, ``p = 1 + (n - a) // (3 + g % 8)``. Other texts, and those
    without an id, stay."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")
    w = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))

    def of(words):
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(words, (a + i % p).cast("int")))
        return F.when(n > 0, F.concat_ws(" ", F.slice(words, F.lit(1), a.cast("int")), tail)).otherwise(text)

    # One element, so that the words are found once.
    return F.when(h % 10 == 0, F.get(F.transform(F.array(w), of), F.lit(0))).otherwise(text)


def op12(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256."""
    found = periodic_runs(docs.select("doc_id", repeated_tail(F.col("doc_id"), F.col("text")).alias("text")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    # Products instead of quotients: exact; of equal ones the first stays.
    best = F.aggregate("runs", none, lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.sha2(lines, 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"), best.alias("b"))
    return out.select("doc_id", "n_runs", "b.start", "b.length", "b.period",
                      F.expr("1000 * b.length div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
