"""MinHash near-duplicates: one-permutation hashing with optimal
densification, banded buckets and star-shaped candidate edges.

1. Signatures (one pass, numpy): words, distinct word shingles as 64-bit
   hashes; the hash space is cut into ``bins``, a set's value in a bin is its
   smallest hash there, empty bins borrow from bins found by a fixed probe
   sequence (optimal densification); ``rows`` bins make a band.
2. Equal sets form one class, a node with a number of its own, so groups of
   exact copies cost one node however large they are.
3. Stars: in each bucket ``centres`` members (the first by a hash that differs
   from band to band) are paired with every other member: first inside each
   Arrow batch, then among what the batches send on, by a window. Pairs grow
   linearly with a bucket, a bucket of up to ``centres + 1`` is compared in full,
   and a member of a larger one meets other centres in every band.
4. Candidate pairs are confirmed on their full shingle sets.
5. Only buckets above ``centres + 1`` are left, a small part. Those whose members are
   not yet in one component meet again with another centre, at most ``rounds`` times:
   the member with most confirmed links, then a random one, paired with the
   members outside its component. New links contract the known components.
6. What is still in several components of a bucket is finished exactly: the
   members of such buckets are compared by a prefix filter. Shingles are ordered
   by the number of those members that have them, rare ones first; two sets at
   the threshold share one of the first ``n - ceil(n * threshold) + 1`` of each.
   Members meet by such a shingle, in blocks of ``BLOCK`` by ``BLOCK``, with all
   that are not of their component; sizes and places in the order leave most
   out. So no pair that shares a bucket is left untested, however many rounds ran.
7. Components by alternating stars; a document has its class's.

A set below ``threshold / (1 - threshold)`` shingles can only be linked to an
equal one, which step 2 does exactly; for larger ones the chance that a pair at the
threshold shares no bucket is ``(1 - 0.80**7)**36``, about 2 in 10,000, and with
``Params(3, 85, rows=8)`` it is ``(1 - 0.85**8)**32``, about 4 in 100,000.

Defined results: null and empty texts have an empty set and are linked with
nothing; a row without an id takes no part (component null, kept); rows that
repeat an id are documents of their own, linked if their sets are near; an
empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinari.llm import words
from opinari.llm.common import fresh, join_hot, written
from opinari.llm.components import components
from opinari.llm.words import mix64

#: Rows of a few numbers that may be broadcast.
BROADCAST_ROWS = 500_000
#: Members that meet by one shingle are cut into blocks of about so many.
BLOCK = 1_000


@dataclass(frozen=True)
class Params:
    shingle: int = 5
    percent: int = 80        # linked: 100 * intersection >= percent * union
    bins: int = 256          # a power of two
    rows: int = 7            # bins in a band
    centres: int = 3         # members of a bucket that are paired with all others at first
    rounds: int = 2          # further rounds at most, before the rest is compared exactly

    @property
    def bands(self) -> int:
        return self.bins // self.rows


_ODD = mix64(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """``(row, sorted distinct shingle hashes)`` of each text; a text with fewer
    words than ``size`` has its whole sequence as one shingle."""
    for i, j, first, h, *_ in words.slices(column, words.SPACED):
        rolled = None
        if len(h) >= size:
            rolled = h[:len(h) - size + 1] * _ODD[0]
            for t in range(1, size):
                rolled += h[t:len(h) - size + 1 + t] * _ODD[t]
            rolled = mix64(rolled)
        for k in range(i, j):
            lo, hi = first[k - i], first[k - i + 1]
            if hi - lo >= size:
                yield k, np.unique(rolled[lo:hi - size + 1])
            elif hi > lo:
                yield k, mix64((h[lo:hi] * _ODD[:hi - lo]).sum(keepdims=True) + np.uint64(hi - lo))
            else:
                yield k, np.zeros(0, dtype=np.uint64)


_PROBES: dict[int, np.ndarray] = {}


def _probes(bins: int, block: int) -> np.ndarray:
    """Probe sequence of every bin, 32 steps at a time."""
    key = bins << 20 | block
    if key not in _PROBES:
        step = np.arange(block * 32, block * 32 + 32, dtype=np.uint64)
        at = np.arange(bins, dtype=np.uint64)[:, None] * np.uint64(1 << 32) + step[None, :]
        _PROBES[key] = (mix64(at + np.uint64(7)) & np.uint64(bins - 1)).astype(np.int64)
    return _PROBES[key]


def signature(s: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of a non-empty sorted set, densified."""
    bin_of = (s >> np.uint64(64 - bins.bit_length() + 1)).astype(np.int64)
    head = np.flatnonzero(np.r_[True, bin_of[1:] != bin_of[:-1]])
    sig = np.zeros(bins, dtype=np.uint64)
    full = np.zeros(bins, dtype=bool)
    sig[bin_of[head]], full[bin_of[head]] = s[head], True
    todo, block = np.flatnonzero(~full), 0
    while len(todo):
        probe = _probes(bins, block)[todo]
        hit = full[probe]
        some = hit.any(axis=1)
        sig[todo[some]] = sig[probe[some, hit[some].argmax(axis=1)]]
        todo, block = todo[~some], block + 1
    return sig


def _class_key(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    return mix64(s).sum(), np.bitwise_xor.reduce(mix64(s + np.uint64(99)))


def _signatures(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    salt = mix64(np.arange(1, p.bands + 1, dtype=np.uint64))
    least = -(-p.percent // (100 - p.percent)) if p.percent < 100 else 1 << 62
    for batch in batches:
        m = batch.num_rows
        n, k1, k2 = np.zeros(m, np.int64), np.zeros(m, np.uint64), np.zeros(m, np.uint64)
        bands, has = np.zeros((m, p.bands), np.uint64), np.zeros(m, bool)
        for k, s in shingle_sets(batch.column(1), p.shingle):
            n[k] = len(s)
            if len(s):
                k1[k], k2[k] = _class_key(s)
                if len(s) >= least:
                    sig = signature(s, p.bins)[:p.bands * p.rows].reshape(p.bands, p.rows)
                    bands[k], has[k] = mix64((sig * _ODD[:p.rows]).sum(axis=1) + salt), True
        offsets = np.r_[0, np.cumsum(np.where(has, p.bands, 0))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array(n), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(bands[has].ravel().view(np.int64)))],
            names=["doc_id", "h", "n_shingles", "k1", "k2", "bands"])


def _stars(batches: Iterator[pa.RecordBatch], centres: int) -> Iterator[pa.RecordBatch]:
    """Per batch and bucket: ``(key, member, null)`` for the first ``centres`` members
    and ``(null, centre, member)`` for every later one and each of them."""
    for batch in batches:
        bands = batch.column(1)
        keys = bands.flatten().to_numpy(zero_copy_only=False)
        if not len(keys):
            continue
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False),
                        bands.value_lengths().to_numpy(zero_copy_only=False))
        order = np.lexsort((ids, mix64(ids.view(np.uint64) ^ keys.view(np.uint64)), keys))
        keys, ids = keys[order], ids[order]
        head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        start = np.repeat(head, np.diff(np.r_[head, len(keys)]))
        rank = np.arange(len(keys)) - start
        late = np.flatnonzero(rank >= centres)
        a = np.concatenate([ids[start[late] + t] for t in range(centres)])
        b = np.tile(ids[late], centres)
        pair, sent = a != b, rank < centres
        k, m = int(sent.sum()), int(pair.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array(keys[sent]), pa.nulls(m, pa.int64())]),
             pa.array(np.r_[ids[sent], a[pair]]),
             pa.concat_arrays([pa.nulls(k, pa.int64()), pa.array(b[pair])])],
            names=["key", "a", "b"])


def _sets(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [s for _, s in shingle_sets(batch.column(1), p.shingle)]
        keys = np.array([_class_key(s) if len(s) else (0, 0) for s in found], dtype=np.uint64).reshape(len(found), 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys[:, 0]), pa.array(keys[:, 1]),
                                          pa.array([s.tobytes() for s in found], pa.binary())], names=["doc_id", "k1", "k2", "shingles"])


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, at in zip(batch.column(0).to_pylist(), batch.column(1)):
            x = np.frombuffer(at.as_buffer(), dtype=np.int64)
            yield from words.parts([np.full(len(x), k), np.full(len(x), len(x)), x], ["id", "n", "x"])


def _confirm(batches: Iterator[pa.RecordBatch], p: Params) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = np.zeros(batch.num_rows, dtype=bool)
        for k, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
            x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
            if 100 * min(len(x), len(y)) >= p.percent * max(len(x), len(y)):
                both = np.sort(np.concatenate([x, y]), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok[k] = 100 * common >= p.percent * (len(x) + len(y) - common)
        mask = pa.array(ok)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])


def _pairs(stars: DataFrame, centres: int) -> DataFrame:
    """Distinct candidate pairs: those found inside batches, and what the
    batches sent of each bucket with its first ``centres`` members there."""
    order = Window.partitionBy("key").orderBy(F.xxhash64("a", "key"), "a")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    far = stars.where("key is not null").select(
        F.col("a").alias("b"), *[F.nth_value("a", t + 1).over(whole).alias(f"c{t}") for t in range(centres)])
    far = far.where("c1 is not null" if centres > 1 else "true") \
        .select(F.explode(F.array(*[f"c{t}" for t in range(centres)])).alias("a"), "b")
    near = stars.where("key is null").select("a", "b")
    return near.union(far).where("a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _few(df: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, marked for broadcast if it is small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _grouped(docs: DataFrame, p: Params, doc_id: str, text: str) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, node_group (null: in none) and component_id of every row, written."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    sig = written(rows.mapInArrow(lambda it: _signatures(it, p), "doc_id long, h long, n_shingles long, k1 long, k2 long, bands array<long>"),
                  "signatures")
    # Equal sets have equal bands, so any row's will do.
    nodes = sig.where("n_shingles > 0 and doc_id is not null").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    known = written(_components(rows, nodes, p), "components")
    of = nodes.select("k1", "k2", "rep", "copies", F.col("node").alias("id")).join(known, "id", "left") \
        .select("k1", "k2", "rep", "copies", F.coalesce("component", "id").alias("node_group"))
    first = of.groupBy("node_group").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n"))
    count, total = nodes.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    of = join_hot(of, first, ["node_group"], "n", count).withColumn("m", F.col("copies"))
    out = join_hot(sig.select("doc_id", "h", "n_shingles", "k1", "k2"),
                   of.select("k1", "k2", "m", "node_group", "component_id"), ["k1", "k2"], "m", total)
    real = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    return written(out.select("doc_id", "h", "n_shingles", F.when(real, F.col("node_group")).alias("node_group"),
                              F.when(real, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")), "groups")


def near_duplicates(docs: DataFrame, p: Params = Params(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    return _grouped(docs, p, doc_id, text).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, p: Params = Params(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group of near-duplicates does: the one
    with the smallest id; of rows that share id and group, one by hash of the text. Rows without
    an id or words all stay."""
    groups = _grouped(docs, p, doc_id, text)
    id_, h, group, rank = (fresh(docs, c) for c in ("_id", "_h", "_group", "_rank"))
    named = groups.select(F.col("doc_id").alias(id_), F.col("h").alias(h), F.col("node_group").alias(group),
                          (F.col("doc_id") != F.col("component_id")).alias("gone")).where(F.col(group).isNotNull())
    gone = _few(written(named.where("gone").select(id_, h).distinct(), "gone"))
    left = docs.join(gone, (docs[doc_id] == gone[id_]) & (F.xxhash64(docs[text]) == gone[h]), "left_anti")
    # Several rows of one id and group.
    twice = named.where("not gone").groupBy(id_, group).agg(F.count(F.lit(1)).alias("n"), F.collect_set(h).alias("hs")).where("n > 1")
    twice = _few(written(twice.select(id_, group, F.explode("hs").alias(h)), "twice"))
    on = (left[doc_id] == twice[id_]) & (F.xxhash64(left[text]) == twice[h])
    once = left.join(twice, on, "left_anti")
    # The first by hash; of equal texts, which are equal but for other columns, one by those.
    others = [F.col(f"`{c}`") for c in docs.columns if not docs.schema[c].dataType.simpleString().startswith(("map", "variant"))]
    many = left.join(twice, on, "inner").withColumn(rank, F.row_number().over(
        Window.partitionBy(id_, group).orderBy(h, F.xxhash64(*others))))
    return once.union(many.where(F.col(rank) == 1).select(*[many[c] for c in docs.columns]))


def _components(rows: DataFrame, nodes: DataFrame, p: Params) -> DataFrame:
    """(id, component) of the nodes that are linked with others."""
    banded = nodes.where(F.size("bands") > 0).select("node", "bands")
    stars = written(banded.mapInArrow(lambda it: _stars(it, p.centres), "key long, a long, b long"), "stars")
    pairs = written(_pairs(stars, p.centres), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = _few(written(nodes.select("node", "rep", "k1", "k2").join(wanted, "node"), "wanted"))
    found = rows.join(wanted, rows["doc_id"] == wanted["rep"], "left_semi").select("doc_id", "text") \
        .mapInArrow(lambda it: _sets(it, p), "doc_id long, k1 long, k2 long, shingles binary")
    on = (found["doc_id"] == wanted["rep"]) & (found["k1"] == wanted["k1"]) & (found["k2"] == wanted["k2"])
    sets = written(found.join(wanted, on).groupBy(F.col("node").alias("id")).agg(F.first("shingles").alias("shingles")), "sets")
    links = written(_confirmed(pairs, sets, p), "links")
    known = written(components(links), "components")
    buckets = banded.select(F.col("node").alias("id"), F.explode("bands").alias("key"))
    large = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > p.centres + 1).select("key")
    large = _few(written(large, "large"))
    member = written(buckets.join(large, "key", "left_semi"), "buckets")
    return _further(member, pairs, links, known, sets, p)


def _joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known (id, component)`` after the further ``links (a, b)``, by contracting the components; written."""
    a, b = (known.select(F.col("id").alias(c), F.col("component").alias(f"c{c}")) for c in "ab")
    between = links.join(a, "a", "left").join(b, "b", "left") \
        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    new = written(components(between), "contracted")
    to = _few(new.select(F.col("id").alias("old"), F.col("component").alias("to")))
    moved = known.join(to, known["component"] == to["old"], "left").select("id", F.coalesce("to", "component").alias("component"))
    return written(moved.union(new.join(known.select("id"), "id", "left_anti")), "components")


def _further(member: DataFrame, tested: DataFrame, links: DataFrame, known: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """``known`` with what further centres, and then the exact comparison, find in the large buckets ``member``.
    ``tested`` pairs are not tested again."""
    ends = links.select(F.col("a").alias("id")).union(links.select("b"))
    degree = written(ends.groupBy("id").agg(F.count(F.lit(1)).alias("links")), "degrees")
    for turn in range(p.rounds):
        total = member.count()
        if not total:
            return known
        chance = F.xxhash64("id", "key", F.lit(turn)).bitwiseAND(F.lit((1 << 24) - 1))
        rank = chance if turn % 2 else F.shiftleft(F.coalesce("links", F.lit(0)).cast("long"), 24) + chance
        placed = written(member.join(known, "id", "left").join(degree, "id", "left").select(
            "key", "id", F.coalesce("component", "id").alias("part"), rank.alias("rank")), "placed")
        centre = placed.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi"),
            F.max_by("id", "rank").alias("c"), F.max_by("part", "rank").alias("c_part")).where("lo != hi")
        met = written(join_hot(placed, centre.select("key", "n", "c", "c_part"), ["key"], "n", total).where("c is not null"), "met")
        member = met.select("id", "key")                      # only buckets of several components go on
        pairs = met.where("part != c_part").select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()
        pairs = written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.union(pairs)
        found = written(_confirmed(pairs, sets, p), "links")
        if found.limit(1).count():
            known = _joined(known, found)
    found = _rest(member, tested, known, sets, p)
    return known if found is None else _joined(known, found)


def _rest(member: DataFrame, tested: DataFrame, known: DataFrame, sets: DataFrame, p: Params) -> DataFrame | None:
    """Links between components inside buckets that were not compared in full, by an exact prefix filter."""
    total = member.count()
    placed = member.join(known, "id", "left").select("key", "id", F.coalesce("component", "id").alias("part"))
    uneven = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi")) \
        .where((F.col("lo") != F.col("hi")) & (F.col("n") > p.centres + 1)).select("key", "n", F.lit(True).alias("uneven"))
    left = written(join_hot(placed, uneven, ["key"], "n", total).where("uneven").select("id", "part").distinct(), "rest")
    if not left.limit(1).count():
        return None
    one = sets.join(left, "id").select("id", "shingles").mapInArrow(_shingles, "id long, n long, x long")
    one = written(one, "shingles")
    often = written(one.groupBy("x").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "often")
    count = often.agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    # join_hot hands on no weight, so the count goes along twice; a shingle of one member has none.
    ranked = join_hot(one, often.select("x", "f", F.col("f").alias("m")), ["x"], "f", count)
    place = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("m", F.lit(1)), "x")).cast("long")
    need = F.expr(f"n - (n * {p.percent} + 99) div 100 + 1")
    first = ranked.select("id", "n", "x", "m", place.alias("at")).where((F.col("at") <= need) & F.col("m").isNotNull())
    first = written(first.join(left, "id").select("id", "n", "x", "at", "part"), "prefixes")
    # Of a shingle's largest component no two members need to meet, so it is on one side only.
    by_part = first.groupBy("x", "part").agg(F.count(F.lit(1)).alias("n"))
    met = by_part.groupBy("x").agg(F.sum("n").alias("f"), F.max_by("part", F.struct("n", "part")).alias("big"),
                                   F.count(F.lit(1)).alias("parts")).where("parts > 1")
    met = met.select("x", "f", "big", F.ceil(F.col("f") / BLOCK).alias("blocks"))
    first = join_hot(first, met, ["x"], "f", first.count()).where("blocks is not null") \
        .withColumn("s", F.pmod(F.xxhash64("id"), F.col("blocks")))
    first = written(first, "meeting")
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    x = first.where("part != big").select("x", F.col("s").alias("i"), others.alias("j"), F.col("id").alias("a"),
                                          F.col("n").alias("na"), F.col("at").alias("ta"), F.col("part").alias("pa"))
    y = first.select("x", others.alias("i"), F.col("s").alias("j"), F.col("id").alias("b"), F.col("n").alias("nb"),
                     F.col("at").alias("tb"), F.col("part").alias("pb"), F.col("big"))
    # ``common`` words at least; at the first one that both have, no more than what follows can be added.
    common = f"({p.percent} * (na + nb) + {99 + p.percent}) div {100 + p.percent}"
    pairs = x.join(y, ["x", "i", "j"]).where("pa != pb and (pb = big or a < b)") \
        .where(f"100 * least(na, nb) >= {p.percent} * greatest(na, nb) and 1 + least(na - ta, nb - tb) >= {common}")
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return written(_confirmed(written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs"), sets, p), "links")


def _confirmed(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    x = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y") \
        .mapInArrow(lambda it: _confirm(it, p), "a long, b long")
