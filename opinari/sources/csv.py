"""Quoted CSV read in parallel inside one file.

A record may hold line breaks inside quotes, so a byte range alone does not tell
where its records begin; Spark's own ``multiLine`` therefore reads a file in one
task. Here the text source splits files at line breaks as usual, and three
small steps find the records:

1. Every split counts its quotes: one aggregate, one row per split.
2. Splits of a file in order: the parity of all quotes before a split says whether
   it begins inside a quoted field.
3. Each split is read in its task's order; lines are joined while a quote is
   open. A record that crosses a split's end goes to the split where it begins:
   its pieces, at most two of a split, are put together by a join on narrow rows.

Quotes must be used as RFC 4180 has it: a field with quotes, separators or line breaks
is quoted as a whole and quotes in it are doubled (so the count tells the state);
UTF-8; records end with ``\\n`` or ``\\r\\n``; line breaks inside quotes stay as they are
(``multiLine`` makes ``\\n`` of them where records end with ``\\r\\n``). Compressed files are one
split each.

Defined results: empty lines are no records; the first record of each file is its
header; a last record whose quote is never closed is handed on as it stands; an
empty file or one with a header only has no records.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinari.session import scratch_path

#: Splits (path, start, parity: about 150 bytes) whose states may be broadcast.
MAX_BROADCAST = 200_000

#: As the reader and the sink of this library write them.
OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true",
           "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its file, the start of its split and a number that grows with its place in the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")


def _quotes(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether each split begins inside a quoted field."""
    odd = lines.groupBy("file", "block").agg(F.bit_xor(_quotes(F.col("value")) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return odd.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int").alias("inside"))


_FOUND = "file string, block long, kind int, first boolean, record string"
RECORD, HEAD, TAIL = 0, 1, 2


class _Split:
    """The lines of one split that have not become records yet."""

    def __init__(self, file: str, block: int, inside: int):
        self.file, self.block, self.inside = file, block, inside
        self.head = bool(inside)              # still in a record of an earlier split
        self.open: list[str] = []
        self.any = False                      # a record has begun here

    def take(self, value: pa.Array) -> Iterator[tuple[int, bool, pa.Array]]:
        """(kind, first, records) of some more lines."""
        odd = pc.count_substring(value, '"').to_numpy(zero_copy_only=False) % 2
        after = (self.inside + np.cumsum(odd)) % 2
        before = np.r_[self.inside, after[:-1]]
        self.inside = int(after[-1])
        # Lines with neither end in quotes are records; the others are joined up to the line that closes them.
        plain = (before == 0) & (after == 0)
        at = 0
        for k in np.flatnonzero(~plain).tolist():
            if k > at:
                yield RECORD, not self.any, value.slice(at, k - at)
                self.any = True
            self.open.append(value[k].as_py())
            if not after[k]:
                yield HEAD if self.head else RECORD, not self.head and not self.any, pa.array(["\n".join(self.open)], pa.string())
                self.any |= not self.head
                self.head, self.open = False, []
            at = k + 1
        if at < len(value):
            yield RECORD, not self.any, value.slice(at)
            self.any = True

    def rest(self) -> tuple[int, bool, pa.Array] | None:
        if not self.open:
            return None
        return HEAD if self.head else TAIL, not self.head and not self.any, pa.array(["\n".join(self.open)], pa.string())


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of the splits of one task, which come one after the other."""
    now: _Split | None = None

    def batch(split: _Split, kind: int, first: bool, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        flags = np.zeros(n, dtype=bool)
        flags[0] = first
        return pa.RecordBatch.from_arrays(
            [pa.array([split.file] * n, pa.string()), pa.array(np.full(n, split.block)), pa.array(np.full(n, kind, np.int32)),
             pa.array(flags), records], names=["file", "block", "kind", "first", "record"])

    def joined(split: _Split, found) -> Iterator[pa.RecordBatch]:
        """Neighbouring small results as one batch."""
        some, size = [], 0
        for kind, first, records in found:
            some.append(batch(split, kind, first, records))
            size += len(records)
            if size >= 10_000:
                yield from pa.Table.from_batches(some).combine_chunks().to_batches()
                some, size = [], 0
        if some:
            yield from pa.Table.from_batches(some).combine_chunks().to_batches()

    for b in batches:
        block = b.column(1).to_numpy()
        file = b.column(0).dictionary_encode()
        code = file.indices.to_numpy(zero_copy_only=False)
        heads = np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (code[1:] != code[:-1])]) if len(block) else []
        for i, j in zip(heads, [*heads[1:], len(block)]):
            name, start = file.dictionary[code[i]].as_py(), int(block[i])
            if now is None or (now.file, now.block) != (name, start):
                if now is not None and (left := now.rest()):
                    yield batch(now, *left)
                now = _Split(name, start, b.column(2)[i].as_py())
            yield from joined(now, now.take(b.column(3).slice(i, j - i)))
    if now is not None and (left := now.rest()):
        yield batch(now, *left)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): the text of every CSV record under ``path`` but the files' first ones, read by as many
    tasks as the text source makes of the files (``spark.sql.files.maxPartitionBytes``)."""
    lines = _lines(spark, path)
    at = scratch_path(spark, "csv-splits")
    split_states(lines).write.parquet(at)
    states = spark.read.parquet(at)
    if states.count() <= MAX_BROADCAST:
        ordered = lines.join(F.broadcast(states), ["file", "block"])          # keeps the lines' order
    else:
        ordered = lines.join(states, ["file", "block"]).sortWithinPartitions("file", "block", "line")
    found = ordered.select("file", "block", "inside", "value").mapInArrow(_assemble, _FOUND)
    # The pieces are few, and read twice below.
    at = scratch_path(spark, "csv-records")
    found.write.partitionBy("kind").parquet(at)
    found = spark.read.schema(_FOUND).parquet(at)
    whole = found.where(F.col("kind") == RECORD).select("file", "block", "first", "record")
    pieces = found.where(F.col("kind") != RECORD)
    # A split's head comes before its tail; heads belong to the last tail before them.
    order = Window.partitionBy("file").orderBy("block", "kind")
    owner = F.last(F.when(F.col("kind") == TAIL, F.col("block")), ignorenulls=True).over(order)
    owners = pieces.select("file", "block", "kind").select("file", "block", "kind", owner.alias("owner"))
    together = pieces.join(owners, ["file", "block", "kind"]).groupBy("file", F.coalesce("owner", F.lit(-1)).alias("block")).agg(
        F.bool_or("first").alias("first"), F.array_sort(F.collect_list(F.struct(F.col("block").alias("b"), "kind", "record"))).alias("p"))
    together = together.select("file", "block", "first", F.array_join(F.transform("p", lambda p: p["record"]), "\n").alias("record"))
    out = whole.union(together).where(~(F.col("first") & (F.col("block") == 0)))
    plain = F.regexp_replace("record", r"\r$", "")
    return out.select("file", plain.alias("record")).where("record != ''")


def read_csv(spark: SparkSession, path: str, schema: T.StructType, corrupt_col: str | None = None) -> DataFrame:
    """The rows of the quoted CSV files under ``path``, columns by position as in ``schema``; one named
    ``corrupt_col`` takes the raw text of records that do not fit it."""
    options = {**OPTIONS, **({"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {})}
    row = F.from_csv("record", _ddl(schema), options)
    return records(spark, path).select(row.alias("row")).select(*[F.col("row").getField(f).alias(f) for f in schema.fieldNames()])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
