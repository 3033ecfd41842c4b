"""Approximate nearest neighbours by cosine: balanced posting lists.

* Fit, on a bounded sample (``SAMPLE`` rows at most about, chosen by hash of the
  id): balanced k-means on the unit sphere (a list's price grows with its
  size), and a neighbour graph over the centroids.
* Index, every row: equal vectors become one entry that keeps its ``k + 1``
  smallest ids, which is all that a top-k with ties to smaller ids can show; an
  entry goes to the list of its nearest centroid and, near a boundary, also to
  others (closure ``1 + REPLICATE`` of the smallest distance, without centroids
  that a chosen one shadows).
* Calibration: the true nearest entries of ``HELD`` queries (by hash of the id),
  by brute force over all entries, show at which place of a query's order of
  lists they are met. A search looks into as many lists, and as far, as gave
  ``RECALL`` of them; there is no cap. Where that is more than ``PROBES``
  lists, the least there are, fewer and larger lists are tried, so that the (query, list) rows don't
  grow with the number of lists; what is compared then grows, as it must.
* Search: a query's nearest centroids are found in memory, by the graph or, if
  many are wanted, by comparing all of them. Queries and
  entries meet per list; large lists are cut into blocks of ``BLOCK`` entries by
  ``BLOCK`` queries, all of them compared. Each block keeps its best per query.

Graph and centroids are bounded by the sample (at most ``SAMPLE / 16``
centroids), so their broadcast is, too.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components take no part, neither do vectors of another length than
most have (ties: the shorter); ids that repeat with different vectors are
candidates with each; a null id takes no part; equal scores rank by smaller
id; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinari.llm.common import written

SAMPLE = 50_000
LIST = 128            # entries per list that the number of lists aims at
BLOCK = 2_000
DEGREE = 24
BEAM = 96
REPLICATE, REPLICAS = 0.15, 4
PRUNE, PROBES = 0.6, 64     # the least reach; above so many lists per query, fewer, larger lists are tried
HELD, RECALL = 256, 0.97
FEWEST = 256          # the number of lists is not halved below this


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _far(dots: np.ndarray) -> np.ndarray:
    """Euclidean distance of unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * dots, 0.0))


@dataclass
class Graph:
    """Centroids and, for each, its nearest others; searched best first."""

    centres: np.ndarray
    edges: np.ndarray
    entry: np.ndarray

    def search(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and distances of each row's ``beam`` nearest centroids as the graph finds them, nearest first."""
        n, k = len(x), len(self.centres)
        beam = min(beam, k)
        if beam * 16 >= k:                     # the graph would meet most of them
            dist = _far(x @ self.centres.T)
            ids = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            return ids, np.take_along_axis(dist, ids, axis=1)
        rows = np.arange(n)[:, None]
        ids = np.repeat(self.entry[None, :], n, axis=0)
        dist = _far(x @ self.centres[self.entry].T)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, self.entry] = True
        done = np.zeros_like(dist, dtype=bool)
        while True:
            order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
            ids, dist, done = ids[rows, order], dist[rows, order], done[rows, order]
            open_ = ~done & np.isfinite(dist)
            live = np.flatnonzero(open_.any(axis=1))
            if not len(live):
                return ids, dist
            best = open_[live].argmax(axis=1)
            done[live, best] = True
            near = self.edges[ids[live, best]]
            new = ~seen[live[:, None], near] & (near != ids[live, best][:, None])
            seen[live[:, None], near] = True
            d = np.full((n, near.shape[1]), np.inf)
            d[live] = np.where(new, _far(np.einsum("nd,nkd->nk", x[live], self.centres[near])), np.inf)
            more = np.zeros((n, near.shape[1]), dtype=np.int64)
            more[live] = near
            ids, dist = np.hstack([ids, more]), np.hstack([dist, d])
            done = np.hstack([done, np.zeros_like(d, dtype=bool)])


def fit(sample: np.ndarray, lists: int, rounds: int = 10) -> Graph:
    """Balanced k-means and graph over unit vectors; the same rows give the same result."""
    rng = np.random.default_rng(7)
    centres = sample[np.sort(rng.choice(len(sample), lists, replace=False))].copy()
    size = np.full(lists, len(sample) / lists)
    for _ in range(rounds):
        price = 0.1 * (size / size.mean() - 1.0)
        owner = np.concatenate([(sample[i:i + 4096] @ centres.T - price * 0.5).argmax(axis=1)
                                for i in range(0, len(sample), 4096)])
        size = np.bincount(owner, minlength=lists).astype(float)
        total = np.zeros_like(centres)
        np.add.at(total, owner, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        centres = np.where(norm > 0, total / np.maximum(norm, 1e-30), centres)
    near = np.concatenate([np.argsort(-(centres[i:i + 512] @ centres.T), axis=1, kind="stable")[:, 1:DEGREE + 1]
                           for i in range(0, lists, 512)]) if lists > 1 else np.zeros((1, 1), dtype=np.int64)
    # A few links to anywhere keep the graph connected.
    anywhere = rng.integers(0, lists, (lists, 4))
    edges = np.sort(np.hstack([near, anywhere]), axis=1)
    own = np.arange(lists)[:, None]
    edges[:, 1:] = np.where(edges[:, 1:] == edges[:, :-1], own, edges[:, 1:])      # a link to itself is none
    return Graph(centres, edges, np.unique(np.r_[0, rng.integers(0, lists, 16)]))


def _replicas(g: Graph, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list) pairs of the entries."""
    ids, dist = g.search(x, 16)
    keep = np.zeros_like(dist, dtype=bool)
    keep[:, 0] = True
    for j in range(1, ids.shape[1]):
        ok = (dist[:, j] <= (1 + REPLICATE) * dist[:, 0]) & (keep.sum(axis=1) < REPLICAS)
        for i in range(j):
            between = _far(np.einsum("nd,nd->n", g.centres[ids[:, j]], g.centres[ids[:, i]]))
            ok &= ~(keep[:, i] & (between < 0.6 * dist[:, j]))
        keep[:, j] = ok
    row, col = np.nonzero(keep)
    return row, ids[row, col]


@dataclass
class Reach:
    """How many lists a query looks into at least, and how far in multiples of the nearest one's distance;
    ``PROBES`` and ``1 + PRUNE`` where these are less."""

    probes: int
    ratio: float

    def __call__(self, g: Graph, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, dist = g.search(x, max(BEAM, self.probes + self.probes // 2))
        probes, ratio = max(self.probes, PROBES), max(self.ratio, 1 + PRUNE)
        ids, dist = ids[:, :probes], dist[:, :probes]
        row, col = np.nonzero(dist <= ratio * np.maximum(dist[:, :1], 1e-9) + 1e-9)
        return row, ids[row, col]


def reach(g: Graph, x: np.ndarray, asker: np.ndarray, near: np.ndarray) -> Reach:
    """The smallest reach with which the queries ``x`` meet ``RECALL`` of their true neighbours:
    ``near[i]`` is one of query ``asker[i]``."""
    if not len(near):
        return Reach(len(g.centres), np.inf)
    row, to = _replicas(g, near)
    dist = _far(x @ g.centres.T)
    place = np.empty(dist.shape, dtype=np.int64)
    np.put_along_axis(place, np.argsort(dist, axis=1, kind="stable"), np.arange(dist.shape[1])[None, :], axis=1)
    first = np.full(len(near), dist.shape[1])
    np.minimum.at(first, row, place[asker[row], to])
    probes = int(np.sort(first)[int(np.ceil(RECALL * len(near))) - 1]) + 1
    # Of those met by then, none is lost by the distance.
    met = place[asker[row], to] == first[row]
    met &= first[row] < probes
    d = dist[asker[row[met]], to[met]] / np.maximum(dist[asker[row[met]]].min(axis=1), 1e-9)
    return Reach(probes, float(d.max()) * (1 + 1e-9))


def _nearest(base: DataFrame, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row of x, unit vector)`` of the ``k`` nearest entries by brute force, without those of the same direction."""
    shared = base.sparkSession.sparkContext.broadcast(x)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        rows, dots, best = np.zeros(0, np.int64), np.zeros(0), np.zeros((0, asked.shape[1]))
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                v = _unit(_vectors(whole.column(0).slice(at, 4096)))
                s = asked @ v.T
                s[s > 1 - 1e-9] = -np.inf
                most = min(k, len(v))
                col = np.argpartition(-s, most - 1, axis=1)[:, :most]
                r = np.repeat(np.arange(len(asked)), most)
                rows, dots, best = np.r_[rows, r], np.r_[dots, s[r, col.ravel()]], np.concatenate([best, v[col.ravel()]])
                order = np.lexsort((-dots, rows))
                head = np.searchsorted(rows[order], np.arange(len(asked)))
                keep = order[(np.arange(len(order)) - head[rows[order]] < k) & np.isfinite(dots[order])]
                rows, dots, best = rows[keep], dots[keep], best[keep]
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(dots), pa.array(list(best), pa.list_(pa.float64()))],
                                         names=["q", "dot", "v"])

    found = base.select("v").mapInArrow(run, "q long, dot double, v array<double>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("dot"), F.xxhash64("v")))
    got = found.select("q", "v", rank.alias("rank")).where(F.col("rank") <= k).select("q", "v").toArrow()   # HELD * k rows
    q = got.column(0).to_numpy().astype(np.int64)
    v = got.column(1).combine_chunks() if got.num_rows else None
    return q, (_vectors(v) if v is not None else np.zeros((0, x.shape[1])))


def _vectors(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 1))


def _usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v) of the rows with an id and a vector that has a direction."""
    rows = df.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(sound & F.exists("v", lambda x: x != 0.0))


def _commonest_length(rows: DataFrame) -> int:
    found = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return found[0][0] if found else 0


def entries(df: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their ``k + 1`` smallest ids: (e, ids, v); ``e`` is the first id."""
    key = ["h1", "h2"]
    hashed = df.select("*", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")).dropDuplicates(["id", *key])
    first = hashed.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy("id"))).where(F.col("rank") <= k + 1)
    return first.groupBy(*key).agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("v").alias("v")) \
        .select("h1", "h2", "ids", "v")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest among ``vectors``, without the query's own id."""
    spark = vectors.sparkSession
    usable = _usable(vectors, vec_id, vector)
    # Decided once, from the vectors; queries of another length take no part.
    alike = F.size("v") == _commonest_length(usable)
    base = written(entries(usable.where(alike), k), "entries")
    asked = _usable(queries, vec_id, vector).where(alike).distinct()
    n = base.count()
    out = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], out)
    step = max(1, -(-n // SAMPLE))
    got = base.where(F.pmod("h1", F.lit(step)) == 0).select("v").toArrow().column(0)
    sample = _vectors(pa.concat_arrays(got.chunks) if got.num_chunks else pa.array([], got.type))
    if not len(sample):
        sample = _vectors(pa.concat_arrays(base.limit(1).select("v").toArrow().column(0).chunks))
    sample = _unit(sample[np.lexsort(sample.T)])
    lists = max(1, min(n // LIST, len(sample) // 16))
    held = asked.orderBy(F.xxhash64("id"), "id").select("v").limit(HELD).toArrow().column(0)
    if len(held):
        x = _unit(_vectors(held.combine_chunks()))
        asker, near = _nearest(base, x, k)
    while True:
        fitted = fit(sample, lists)
        find = reach(fitted, x, asker, near) if len(held) else Reach(1, np.inf)
        if find.probes <= PROBES or lists < 2 * FEWEST:
            break
        # As many lists as would bring the probes down, if these keep their share.
        lists = max(FEWEST, min(lists // 2, lists * PROBES // find.probes))
    graph = spark.sparkContext.broadcast(fitted)

    def deal(to_lists):
        """Rows with the lists they go to."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 512):
                    batch = whole.slice(at, 512)
                    row, to = to_lists(graph.value, _unit(_vectors(batch.column(batch.schema.get_field_index("v")))))
                    kept = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(to, pa.int64())], names=[*batch.schema.names, "list"])
        return run

    posted = written(base.mapInArrow(deal(_replicas), "h1 long, h2 long, ids array<long>, v array<double>, list long"), "postings")
    probed = written(asked.select("id", "v").mapInArrow(deal(find), "id long, v array<double>, list long"), "probes")
    # Blocks per list: at most as many rows as there are lists.
    size = posted.groupBy("list").agg(F.count(F.lit(1)).alias("p")).join(
        probed.groupBy("list").agg(F.count(F.lit(1)).alias("q")), "list")
    size = F.broadcast(size.select("list", F.ceil(F.col("p") / BLOCK).alias("pb"), F.ceil(F.col("q") / BLOCK).alias("qb")))
    left = probed.join(size, "list").select(
        "list", F.pmod(F.xxhash64("id", "v"), F.col("qb")).alias("qs"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("pb") - 1)).alias("ps"), "id", "v")
    right = posted.join(size, "list").select(
        "list", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qb") - 1)).alias("qs"), F.pmod("h1", F.col("pb")).alias("ps"), "ids", "v")

    def meet(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(p):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        a, b = np.stack(q["v"].to_numpy()), np.stack(p["v"].to_numpy())
        na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
        rough = (a / na[:, None]) @ (b / nb[:, None]).T
        most = min(len(b), k + 4)
        ids = p["ids"].tolist()
        found = []
        for i, own in enumerate(q["id"].tolist()):
            cut = np.partition(rough[i], len(b) - most)[len(b) - most] - 1e-9
            near = np.flatnonzero(rough[i] >= cut)
            exact = (b[near] * a[i]).sum(axis=1) / (na[i] * nb[near])
            mine = sorted((-s, x, own) for s, j in zip(exact.tolist(), near.tolist()) for x in ids[j] if x != own)
            found.extend(mine[:k])
        return pd.DataFrame({"query_id": [o for _, _, o in found], "vec_id": [x for _, x, _ in found],
                             "score": [-s for s, _, _ in found]}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    near = left.groupBy("list", "qs", "ps").cogroup(right.groupBy("list", "qs", "ps")) \
        .applyInPandas(meet, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return near.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)


def op3(vectors: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` nearest of every vector whose vec_id is divisible by 50."""
    return search(vectors, vectors.where(F.col("vec_id") % 50 == 0), k)
