"""Token ids of whole Arrow columns: each distinct word of a portion is looked up
once, by a hash of its bytes (A-Z and a-z differ), and its ids are gathered by
numpy. Words are runs between ASCII white space; see :mod:`opinari.llm.tokens`
for why texts may be cut there."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa

from opinari.llm import tokens, words
from opinari.llm.tokens import Vocabulary
from opinari.llm.words import mix64

#: Bytes of text worked on at a time, and words a worker remembers (about 40 bytes each).
PORTION = 1 << 21
REMEMBERED = 1 << 20

_CODES = mix64(np.arange(1, 257, dtype=np.uint64))


class WordIds:
    """Ids of texts by one vocabulary, with a memory of bounded size."""

    def __init__(self, vocabulary: Vocabulary, most: int = REMEMBERED):
        self.vocabulary, self.most = vocabulary, most
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)              # sorted
        self.at = np.zeros(0, dtype=np.int64)                 # of its ids in ``flat``
        self.size = np.zeros(0, dtype=np.int64)
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint32), 0

    def _learn(self, place: np.ndarray, keys: np.ndarray, chunks: Iterator[bytes]) -> None:
        found = [self.vocabulary.ids(c.decode()) for c in chunks]
        size = np.array([len(x) // 4 for x in found], dtype=np.int64)
        new = np.frombuffer(b"".join(found), dtype="<u4")
        if self.used + len(new) > len(self.flat):
            self.flat = np.r_[self.flat[:self.used], np.zeros(self.used + 2 * len(new), dtype=np.uint32)]
        self.flat[self.used:self.used + len(new)] = new
        at = self.used + np.cumsum(size) - size
        self.used += len(new)
        self.keys, self.at, self.size = (np.insert(a, place, b) for a, b in ((self.keys, keys), (self.at, at), (self.size, size)))

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text k has ``ids[bounds[k]:bounds[k + 1]]``."""
        raw, _ = words.buffers(column)
        hashes, starts, ends, counts = [], [], [], []
        for _, _, first, h, s, e, base in words.slices(column, words.SPACED, _CODES):
            hashes.append(h)
            starts.append(s + base)
            ends.append(e + base)
            counts.append(np.diff(first))
        bounds = np.zeros(len(column) + 1, dtype=np.int64)
        if not hashes:
            return np.zeros(0, dtype=np.uint32), bounds
        h, first = np.concatenate(hashes), np.r_[0, np.cumsum(np.concatenate(counts))]
        key, where, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(key) > self.most:
            self._forget()
        place = np.searchsorted(self.keys, key)
        missing = np.ones(len(key), dtype=bool)
        inside = place < len(self.keys)
        missing[inside] = self.keys[place[inside]] != key[inside]
        if missing.any():
            s, e = np.concatenate(starts)[where[missing]].tolist(), np.concatenate(ends)[where[missing]].tolist()
            view = memoryview(raw)
            self._learn(place[missing], key[missing], (bytes(view[i:j]) for i, j in zip(s, e)))
            place = np.searchsorted(self.keys, key)
        size = self.size[place][which]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        ids = self.flat[np.repeat(self.at[place][which] - (end - size), size) + np.arange(total)]
        bounds[:] = np.r_[0, end][first]
        return ids, bounds

    def portions(self, batch: pa.RecordBatch, text: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
        """A batch in portions of about ``PORTION`` bytes of text, with ids and bounds."""
        for part in words.portions(batch, text, PORTION):
            yield part, *self.of(part.column(text))


_WORKER: dict = {}


def of_worker(shared, most: int = REMEMBERED, merges: int = tokens.REMEMBERED // 3) -> WordIds:
    """This worker's memory for a broadcast vocabulary: ``most`` words and ``merges`` merged pre-tokens."""
    key = (most, merges, shared.value.content[:200], len(shared.value.content))
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = WordIds(replace(shared.value, merges=merges, _loaded={}), most)
    return _WORKER[key]
