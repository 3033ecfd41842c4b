"""Word splitting and 64-bit word hashes over whole Arrow string columns.

Words are maximal runs of "word bytes" of the UTF-8 text; A-Z count as a-z.
Everything is numpy over slices of the column's own buffer: a word's hash is
the sum of ``code[byte] * M**position`` (mod 2**64) over its bytes, taken for
all words of a slice with one ``add.reduceat`` and moved to position 0 by the
inverse power, then mixed. No Python object per word, no dictionary, and the
working set is bounded by the slice, not by the batch or by one long text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 16      # bytes of text worked on at a time; its arrays fit the cache
_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def is_word(separators: str) -> np.ndarray:
    """Byte table (256 bools): every byte but the listed ASCII separators."""
    table = np.ones(256, dtype=bool)
    table[[ord(c) for c in separators]] = False
    return table


#: Words between ASCII white space.
SPACED = is_word(" \t\n\v\f\r")
#: Runs of ASCII letters, digits and everything beyond ASCII.
ALNUM = is_word("".join(chr(i) for i in range(128) if not chr(i).isalnum()))

_FOLD = np.arange(256, dtype=np.uint64)
_FOLD[65:91] += np.uint64(32)
_CODES = mix64(_FOLD + np.uint64(1))


#: Odd multiplier of the first word in the hash of two neighbouring words.
ODD_PAIR = np.uint64(0xD6E8FEB86659FD93)


class _Powers:
    """M**i and M**-i (mod 2**64), grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, SLICE + 64)
            for name, m in (("up", _MULT), ("down", pow(_MULT, -1, 1 << 64))):
                steps = np.full(size, m, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = _Powers()


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return raw, bounds


def _split(data: np.ndarray, bounds: np.ndarray, word: np.ndarray, codes: np.ndarray = _CODES):
    """Starts, ends and hashes of the words of one slice; a document's border
    ends a word."""
    w = word[data]
    begin = w.copy()
    begin[1:] &= ~w[:-1]
    edge = bounds[:-1][bounds[:-1] < len(data)]
    begin[edge] = w[edge]
    start = np.flatnonzero(begin)
    if not len(start):
        return start, start, np.zeros(0, dtype=np.uint64)
    up, down = _POWERS.upto(len(data))
    value = np.where(w, codes[data], np.uint64(0))
    value *= up[:len(data)]
    hashes = np.add.reduceat(value, start) * down[start]
    last = w.copy()
    last[:-1] &= ~w[1:]
    edge = bounds[1:][(bounds[1:] > 0) & (bounds[1:] <= len(data))] - 1
    last[edge] = w[edge]
    return start, np.flatnonzero(last) + 1, mix64(hashes)


def _long(data: np.ndarray, word: np.ndarray, codes: np.ndarray = _CODES):
    """One text above the slice size, cut at separators."""
    parts, at = [], 0
    while at < len(data):
        to = min(at + SLICE, len(data))
        while to < len(data):
            gap = np.flatnonzero(~word[data[at:to]])
            if len(gap):
                to = at + int(gap[-1]) + 1
                break
            to = min(to + SLICE, len(data))
        s, e, h = _split(data[at:to], np.array([0, to - at]), word, codes)
        parts.append((s + at, e + at, h))
        at = to
    return tuple(np.concatenate(x) for x in zip(*parts))


def slices(column: pa.Array, word: np.ndarray, codes: np.ndarray = _CODES) -> Iterator[tuple]:
    """Yield ``(i, j, first, hashes, start, end, base)`` for the documents i..j-1 of
    each slice: document k's words are ``first[k-i]:first[k-i+1]``; start and
    end are byte positions relative to ``base`` in the column's buffer. ``codes`` are the bytes'
    codes in the hashes; by default A-Z have those of a-z."""
    raw, bounds = buffers(column)
    n, i = len(bounds) - 1, 0
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + SLICE, side="right")) - 1
        j = min(max(j, i + 1), n)
        lo, hi = int(bounds[i]), int(bounds[j])
        if hi - lo > SLICE:                       # one long document
            s, e, h = _long(raw[lo:hi], word, codes)
        else:
            s, e, h = _split(raw[lo:hi], bounds[i:j + 1] - lo, word, codes)
        yield i, j, np.searchsorted(s, bounds[i:j + 1] - lo), h, s, e, lo
        i = j


def portions(batch: pa.RecordBatch, text: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch's rows in portions of about ``limit`` bytes of the text column, so that what is made from
    them stays small beside the batch."""
    _, bounds = buffers(batch.column(text))
    n, i = batch.num_rows, 0
    while i < n:
        j = min(max(int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1, i + 1), n)
        yield batch.slice(i, j - i)
        i = j


def parts(arrays: list, names: list[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    """Arrays of equal length as record batches of at most ``rows`` rows: the reader holds one at a time."""
    whole = pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in arrays], names=names)
    for i in range(0, whole.num_rows, rows):
        yield whole.slice(i, rows)


def hash_word(text: str) -> int:
    """The hash of one word, as :func:`slices` gives it."""
    total, power = 0, 1
    for b in text.encode():
        total = (total + int(_CODES[b]) * power) & _MASK
        power = power * _MULT & _MASK
    return int(mix64(np.array([total], dtype=np.uint64))[0])
