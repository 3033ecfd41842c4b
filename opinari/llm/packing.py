"""Packing documents into sequences of a fixed number of tokens: best-fit
decreasing over open windows.

Tokenizing cuts each document into full windows and one shorter tail; only
lengths go on. Pieces are dealt by hash of a number of their own into blocks of
about ``BLOCK`` pieces, so a block is bounded whatever the documents are, and
each block is packed on its own: longest piece first, into the open window
with the least room that suffices, found in a segment tree indexed by
remaining capacity. Blocks are independent, so a lost executor costs its
blocks only, and the same written pieces always give the same sequences.

Defined results: null, empty and blank texts are one piece holding only the
end token; equal lengths go by document id, start and checksum; repeated rows
are packed one by one; a null id stays null; an empty table gives no rows.
Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinari.llm import tokens, wordids
from opinari.llm.common import written

WINDOW = 2048
BLOCK = 50_000       # pieces packed together (about 10 MB)


class Rooms:
    """Open windows by remaining capacity: a segment tree of their numbers."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.tree = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.tree[i] += n
            i >>= 1

    def put(self, room: int, number: int) -> None:
        self.open[room].append(number)
        self._add(room, 1)

    def tightest(self, need: int) -> int:
        """The least capacity of an open window that is at least ``need``, or -1."""
        i = need + self.size
        while not self.tree[i]:
            while i & 1:               # a right child: nothing larger below its parent
                i >>= 1
            if i == 0:
                return -1
            i += 1
        while i < self.size:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.size

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.open[room].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int], int]:
    """Window number and offset of each piece, given in decreasing length, and the number of windows."""
    rooms, used = Rooms(window), 0
    number, offset = [], []
    for n in lengths:
        room = rooms.tightest(n) if n < window else -1
        if room < 0:
            room, at = window, used
            used += 1
        else:
            at = rooms.take(room)
        number.append(at)
        offset.append(window - room)
        if room > n:
            rooms.put(room - n, at)
    return number, offset, used


def pieces(docs: DataFrame, vocabulary: tokens.Vocabulary, end: int = 1, window: int = WINDOW,
           doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False,
           remembered: int = wordids.REMEMBERED, merges: int = tokens.REMEMBERED // 3) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids, little-endian) of every piece.
    ``remembered`` and ``merges`` bound a worker's memory of words (about 40 bytes each) and of merged
    pre-tokens (about 200): fewer cost more CPU time."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    last = np.array([end], dtype="<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wordids.of_worker(shared, remembered, merges)
        for batch in batches:
            for part, found, bounds in known.portions(batch, 1):
                data = memoryview(np.ascontiguousarray(found, dtype="<u4").view(np.uint8))
                total = np.diff(bounds) + 1
                many = -(-total // window)
                owner = np.repeat(np.arange(part.num_rows), many)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)) * window
                length = np.minimum(total[owner] - start, window)
                lo = 4 * (bounds[:-1][owner] + start)
                closing = start + length == total[owner]
                hi = lo + 4 * (length - closing)
                crc, ids = [], []
                for i, j, c in zip(lo.tolist(), hi.tolist(), closing.tolist()):
                    crc.append(zlib.crc32(last, zlib.crc32(data[i:j])) if c else zlib.crc32(data[i:j]))
                    if keep_ids:
                        ids.append(bytes(data[i:j]) + last * c)
                columns = [part.column(0).take(pa.array(owner)), *[pa.array(x, pa.int64()) for x in (start, length, crc, total[owner])]]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(ids, pa.binary())] * keep_ids, names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
                           + ", ids binary" * keep_ids)


def pack(parts: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``parts`` (as from :func:`pieces`) with sequence_id and offset."""
    parts = written(parts.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    blocks = max(1, -(-parts.count() // block))
    narrow = parts.select("piece", "doc_id", "start", "length", "ids_crc32",
                          F.pmod(F.xxhash64("piece"), F.lit(blocks)).alias("block"))

    def run(key, frame):
        frame = frame.sort_values(["length", "doc_id", "start", "ids_crc32", "piece"],
                                  ascending=[False, True, True, True, True], kind="stable")
        number, offset, _ = best_fit(frame["length"].tolist(), window)
        return pd.DataFrame({"piece": frame["piece"].to_numpy(), "sequence_id": np.array(number, np.int64) + (int(key[0]) << 32),
                             "offset": np.array(offset, np.int64)})

    placed = narrow.groupBy("block").applyInPandas(run, "piece long, sequence_id long, offset long")
    return parts.join(placed, "piece").drop("piece")


def sequences(docs: DataFrame, vocabulary: tokens.Vocabulary, end: int = 1, pad: int = 0, window: int = WINDOW) -> DataFrame:
    """sequence_id and its ``window`` token ids, padded with ``pad``."""
    packed = pack(pieces(docs, vocabulary, end, window, keep_ids=True), window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(x.as_py()), dtype="<u4") for x in batch.column(1)]
            full = [np.r_[x.astype(np.int32), np.full(window - len(x), pad, np.int32)] for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(full, pa.list_(pa.int32()))], names=["sequence_id", "ids"])

    in_order = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])
    return packed.groupBy("sequence_id").agg(in_order.alias("ids")).mapInArrow(run, "sequence_id long, ids array<int>")


def op9(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return pack(pieces(docs, tokens.load(path)))
