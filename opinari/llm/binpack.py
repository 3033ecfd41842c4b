"""Best-fit packing with certified bounds: as few windows as can be, no document cut
that fits into one.

1. Tokenizing gives each document's pieces: full windows of those above one, and
   one shorter rest. Only lengths go on; full windows are windows already.
2. The rest is dealt by hash into partitions of about ``BLOCK`` pieces, each packed
   best fit decreasing. Equal lengths are placed together: the tightest window
   that has room takes as many as fit, which is what one after the other gives.
3. A partition's bound: the largest of a family of dual feasible functions summed
   over its lengths. Any packing needs as many windows, so a partition that
   uses no more is certified. The same functions over the counts of all
   lengths give the bound of the whole.
4. Until the whole's bound is met, there are gaps, in partitions or between them (each
   has a window that isn't full). Then partitions exchange documents: those of
   their windows with more room than the mean of those with room, and of the
   emptiest one, are dealt anew and packed again, as long as this saves windows.
   Well filled windows stay, so what is exchanged shrinks from round to round.
   ``place`` reports the windows used and the bound.

The same written pieces always give the same windows; a lost executor costs its
partitions only.

Defined results: null, empty and blank texts are one piece holding only the end
token; equal lengths go by their row; repeated rows are packed one by one; a
null id stays null; an empty table gives no rows. Only the named columns are read.
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
BLOCK = 200_000      # pieces packed together (about 30 MB)
STEPS = 16           # dual feasible functions of the first family


def best_fit(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window number and offset of each piece, given in decreasing length, and the room left of each window."""
    n = len(lengths)
    number, offset = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    waiting: list[list[np.ndarray]] = [[] for _ in range(window + 1)]      # open windows by room
    rooms, used, at = 0, 0, 0                                              # bits of the rooms that have any

    def put(room: int, who: np.ndarray) -> None:
        nonlocal rooms
        if room and len(who):
            waiting[room].append(who)
            rooms |= 1 << room

    heads = np.flatnonzero(np.r_[True, lengths[1:] != lengths[:-1]]) if n else np.zeros(0, int)
    for lo, hi in zip(heads.tolist(), [*heads[1:].tolist(), n]):
        size, at = int(lengths[lo]), lo
        while at < hi:
            fit = rooms >> size
            if fit:
                room = size + (fit & -fit).bit_length() - 1
                who = waiting[room].pop()
                if not waiting[room]:
                    rooms &= ~(1 << room)
            else:
                room = window
                who = np.arange(used, used - (at - hi) // (window // size))
                used += len(who)
            each = room // size
            take = min(len(who), -((at - hi) // each))
            put(room, who[take:])
            who = who[:take]
            k = min(hi - at, take * each)
            place = np.arange(k)
            number[at:at + k] = who[place // each]
            offset[at:at + k] = window - room + place % each * size
            last = k - (take - 1) * each
            put(room - each * size, who[:-1] if last < each else who)
            if last < each:
                put(room - last * size, who[-1:])
            at += k
    left = np.full(used, window, dtype=np.int64)
    np.subtract.at(left, number, lengths)
    return number, offset, left


def bound(count: np.ndarray, window: int) -> int:
    """Windows that any packing needs: ``count[x]`` pieces of length x, 0 < x <= window. The functions are those that
    round ``(k + 1) x`` down where it is no whole number of windows, after long pieces (above ``window - e``)
    have been counted as whole windows and short ones (below ``e``) as nothing."""
    x = np.flatnonzero(count).astype(np.int64)
    c = count[x].astype(np.int64)
    if not len(x):
        return 0
    limits = np.unique(np.r_[0, x[x <= window // 2], window + 1 - x[x > window // 2]])
    limits = limits[limits <= window // 2]
    best = 0
    for lo in range(0, len(limits), 256):
        e = limits[lo:lo + 256, None]
        y = np.where(x > window - e, window, np.where(x < e, 0, x))
        best = max(best, int((-(-(y @ c) // window)).max()))
        for k in range(1, STEPS + 1):
            many = (k + 1) * y
            value = np.where(many % window == 0, k * y, many // window * window)
            best = max(best, int((-(-(value @ c) // (k * window))).max()))
    return best


def pieces(docs: DataFrame, vocabulary: tokens.Vocabulary, end: int = 0, window: int = WINDOW,
           doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, little-endian) of every piece."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = wordids.of_worker(shared)
        for batch in batches:
            for part, ids, bounds in known.portions(batch, 1):
                data = memoryview(np.ascontiguousarray(ids, dtype="<u4").view(np.uint8))
                total = np.diff(bounds) + 1
                many = -(-total // window)
                owner = np.repeat(np.arange(part.num_rows), many)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
                start = piece * window
                length = np.minimum(total[owner] - start, window)
                lo = 4 * (bounds[:-1][owner] + start)
                closing = start + length == total[owner]
                hi = lo + 4 * (length - closing)
                crc, kept = [], []
                for i, j, c in zip(lo.tolist(), hi.tolist(), closing.tolist()):
                    crc.append(zlib.crc32(last, zlib.crc32(data[i:j])) if c else zlib.crc32(data[i:j]))
                    if keep_ids:
                        kept.append(bytes(data[i:j]) + last * c)
                columns = [part.column(0).take(pa.array(owner)), *[pa.array(x, pa.int64()) for x in (piece, start, length, crc)]]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * keep_ids, names=names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, piece long, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids)


_PLACED = "row long, length long, sequence_id long, offset long, exchanged boolean, gap long"


def _packed(rows: DataFrame, count: int, salt: int, window: int, block: int) -> DataFrame:
    """``rows (row, length)`` dealt into partitions and packed. ``gap`` is what a partition uses above its
    bound, ``exchanged`` marks what it hands over if the whole isn't certified."""
    blocks = max(1, -(-count // block))

    def run(key, frame):
        order = np.lexsort((frame["row"].to_numpy(), -frame["length"].to_numpy()))
        row, length = frame["row"].to_numpy()[order], frame["length"].to_numpy()[order]
        number, offset, left = best_fit(length, window)
        name = np.empty(len(left), dtype=np.int64)            # a window is called by its first piece
        name[number[offset == 0]] = row[offset == 0]
        gap = len(left) - bound(np.bincount(length, minlength=window + 1), window)
        over = left >= left.max()                             # some windows have room, or all are full
        if left.any():
            over |= left > left[left > 0].mean()
        return pd.DataFrame({"row": row, "length": length, "sequence_id": name[number], "offset": offset,
                             "exchanged": (over & (left > 0))[number], "gap": gap})

    dealt = rows.select("row", "length", F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(blocks)).alias("block"))
    return written(dealt.groupBy("block").applyInPandas(run, _PLACED), "placed")


def place(rows: DataFrame, window: int = WINDOW, block: int = BLOCK) -> tuple[DataFrame, int, int]:
    """(row, sequence_id, offset) of ``rows (row, length)``, a written table of pieces shorter than a window, the
    number of windows and its lower bound; ``sequence_id`` is the row of a window's first piece."""
    lengths = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}   # < window rows
    count = np.zeros(window + 1, dtype=np.int64)
    for length, n in lengths.items():
        count[length] = n
    least = bound(count, window)
    windows = lambda df: df.agg(F.count_if(F.col("offset") == 0)).first()[0]
    now = _packed(rows, int(count.sum()), 0, window, block)
    used, turn, fixed = windows(now), 0, None
    while used > least:
        turn += 1
        pool = now.where("exchanged")
        many, had = pool.agg(F.count(F.lit(1)), F.count_if(F.col("offset") == 0)).first()
        if had < 2:
            break
        new = _packed(pool, many, turn, window, block)
        saved = had - windows(new)
        if saved <= 0:
            break
        rest = now.where("not exchanged")
        fixed = rest if fixed is None else fixed.union(rest)
        now, used = new, used - saved
    placed = now if fixed is None else fixed.union(now)
    return placed.select("row", "sequence_id", "offset"), used, least


def pack(parts: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``parts`` (as from :func:`pieces`) with sequence_id and offset."""
    parts = written(parts.withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed, _, _ = place(parts.where(F.col("length") < window).select("row", "length"), window, block)
    whole = parts.where(F.col("length") == window).withColumn("sequence_id", F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    return whole.drop("row").union(parts.where(F.col("length") < window).join(placed, "row").drop("row"))


def op13(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    out = pack(pieces(docs, tokens.load(path)))
    return out.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")
