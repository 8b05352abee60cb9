"""Approximate nearest neighbours over balanced posting lists.

Centroids are fitted by k-means, with a penalty on crowded ones, on at most SAMPLE vectors of smallest hash that are no
queries (a centroid fitted on a query lies too close to it, and the ratio would then leave out too much); every vector is then filed under its nearest centroid, and vectors near a boundary under up to COPIES centroids, those within
NEAR of the nearest one's distance. A query walks a graph over the centroids, held in memory, and searches every list
whose centroid is found within RATIO of the nearest one's distance, and more of the nearest while these hold fewer than
LEAST vectors; no fixed number of lists or steps bounds the walk.
Lists are searched in parts of about PART vectors, several lists or a share of a long one, against about ASKED queries at
a time: a part is repeated only where more than these ask for it, and left out where none does. Each part gives a query
its best k.

Centroids are at most MOST_LISTS, whatever the corpus, so they can be broadcast. Defined results: vectors that are null,
empty, zero, or hold null or non-finite components, or whose length is not the commonest, take no part; equal distances
go to the smaller vec_id; a vec_id that occurs twice is its smallest vector's; null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SAMPLE, MOST_LISTS, LIST, COPIES, PART = 16_384, 2048, 200, 4, 20_000
#: Set by recall and work on vectors with hardly any clusters, where the ratio prunes least (figures in README).
NEAR, RATIO, LEAST, BEAM, STEP, ASKED = 1.01, 1.27, 1500, 32, 8, 50_000
#: Parts whose numbers of queries are broadcast, at most: 12 bytes each.
FEW_PARTS = 200_000


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    dice = np.random.default_rng(seed)
    c = x[dice.choice(len(x), k, replace=False)].astype(np.float64)
    load = np.full(k, len(x) / k)
    for _ in range(rounds):
        d = (c**2).sum(axis=1)[None, :] - 2 * x @ c.T
        d = d + (x**2).sum(axis=1)[:, None]
        d = d * (0.5 + 0.5 * np.sqrt(load * k / len(x)))[None, :]
        near = d.argmin(axis=1)
        load = 0.5 * load + 0.5 * np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=k)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], x[dice.choice(len(x), k)])
    return c


class CentroidGraph:
    """Each centroid's nearest others, the next by number, so that all are connected, and some far ones."""

    def __init__(self, c: np.ndarray, degree: int = 16, far: int = 1, seed: int = 5):
        self.c = c
        n = len(c)
        dice = np.random.default_rng(seed)
        d = ((c**2).sum(axis=1)[None, :] + (c**2).sum(axis=1)[:, None]) - 2 * c @ c.T
        near = np.argsort(d, axis=1)[:, 1 : degree + 1]
        self.edges = [np.unique(np.concatenate([near[i], np.flatnonzero((near == i).any(axis=1)), [(i + 1) % n], dice.integers(0, n, far)])) for i in range(n)]

    def within(self, q: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int]:
        """The centroids found within RATIO of the nearest one's distance, or needed to reach LEAST vectors, nearest
        first, and how many centroids the walk has seen. It follows the edges of all such centroids and of the BEAM
        nearest, until they lead to no more of these: its reach is the ratio's, not a number of steps."""
        ids = np.unique(np.linspace(0, len(self.c) - 1, min(len(self.c), 8)).astype(int))
        dist = np.sqrt(((self.c[ids] - q) ** 2).sum(axis=1))
        seen, done = np.zeros(len(self.c), bool), np.zeros(len(self.c), bool)
        seen[ids] = True
        while True:
            order = np.argsort(dist, kind="stable")
            ids, dist = ids[order], dist[order]
            taken = (dist <= RATIO * dist[0]) | (np.cumsum(sizes[ids]) - sizes[ids] < LEAST)
            open_ = taken.copy()
            open_[:BEAM] = True
            todo = ids[open_ & ~done[ids]][:STEP]
            if not len(todo):
                return ids[taken], len(ids)
            done[todo] = True
            fresh = np.unique(np.concatenate([self.edges[i] for i in todo]))
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            ids = np.concatenate([ids, fresh])
            dist = np.concatenate([dist, np.sqrt(((self.c[fresh] - q) ** 2).sum(axis=1))])


def parts_of(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first part of each list and how many parts it has: lists of up to PART vectors share parts of about PART."""
    first, parts, at, held = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > PART:
            at, held = at + 1, 0
        first[i], parts[i] = at, max(1, -(-n // PART))
        at, held = (at + parts[i], 0) if parts[i] > 1 else (at, held + n)
    return first, parts


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _file(c: np.ndarray, made: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1024):
                part = batch.slice(a, 1024)
                x = matrix(part.column("vec"), c.shape[1])
                d = np.sqrt(np.maximum(0, (x**2).sum(axis=1)[:, None] + (c**2).sum(axis=1)[None, :] - 2 * x @ c.T))
                top = np.argsort(d, axis=1, kind="stable")[:, :COPIES]
                near = np.take_along_axis(d, top, axis=1)
                rows, k = np.nonzero(near <= NEAR * near[:, :1] + 1e-12)
                lists = top[rows, k]
                got = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), got.column("vec_id"), got.column("vec")], schema=made)

    return run


def _probe(c: np.ndarray, sizes: np.ndarray, made: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, (first, parts) = CentroidGraph(c), parts_of(sizes)
        for batch in batches:
            rows, places, lists = [], [], []
            for i, q in enumerate(matrix(batch.column("vec"), c.shape[1])):
                taken = np.sort(graph.within(q, sizes)[0])
                at = np.repeat(first[taken], parts[taken])
                at += np.arange(len(at)) - np.repeat(np.cumsum(parts[taken]) - parts[taken], parts[taken])
                each = np.repeat(taken, parts[taken])
                order = np.argsort(at, kind="stable")
                at, cuts = np.unique(at[order], return_index=True)
                rows += [i] * len(at)
                places += at.tolist()
                lists += np.split(each[order], cuts[1:])
            got = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(lists, pa.list_(pa.int32())), got.column("vec_id"), got.column("vec")], schema=made)

    return run


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(k: int, dim: int):
    def run(key: tuple, filed: pa.Table, asked: pa.Table) -> pa.Table:
        if not filed.num_rows or not asked.num_rows:
            return _FOUND.empty_table()
        filed, asked = filed.combine_chunks(), asked.combine_chunks()
        ids, x, home = filed.column("vec_id").to_numpy(), matrix(filed.column("vec").chunk(0), dim), filed.column("list").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x, home = ids[order], x[order], home[order]
        starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))  # copies of a vector lie together
        ids, x = ids[starts], x[starts]
        lists, home = np.unique(home, return_inverse=True)
        norms = (x**2).sum(axis=1)
        queries, q, wanted = asked.column("vec_id").to_numpy(), matrix(asked.column("vec").chunk(0), dim), asked.column("lists").to_pylist()
        out: list[list[np.ndarray]] = [[np.empty(0, t)] for t in (np.int64, np.int64, np.float64)]
        for a in range(0, len(q), 64):
            some = q[a : a + 64]
            allowed = np.array([np.isin(lists, w) for w in wanted[a : a + 64]])
            d = norms[None, :] + (some**2).sum(axis=1)[:, None] - 2 * some @ x.T
            slack = 1e-9 * (norms.max() + (some**2).sum(axis=1))  # over the rounding of d: exact distances decide
            d[~np.logical_or.reduceat(allowed[:, home], starts, axis=1) | (ids[None, :] == queries[a : a + 64, None])] = np.inf
            last = np.partition(d, k - 1, axis=1)[:, k - 1] if d.shape[1] > k else np.full(len(d), np.inf)
            for i, query in enumerate(queries[a : a + 64]):
                near = np.flatnonzero((d[i] <= last[i] + slack[i]) & np.isfinite(d[i]))
                exact = np.sqrt(np.cumsum((x[near] - some[i]) ** 2, axis=1)[:, -1])  # summed in the order of the components
                best = np.argsort(exact, kind="stable")[:k]
                for v, got in zip(out, (np.full(len(best), query), ids[near[best]], exact[best]), strict=True):
                    v.append(got)
        return pa.table([pa.array(np.concatenate(v)) for v in out], schema=_FOUND)

    return run


def nearest(vectors: DataFrame, queries: str = "vec_id % 100 = 0", k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k vectors found nearest, by Euclidean distance, to each vector for which
    queries holds; vectors has vec_id and embedding."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "nearest")
    vec = F.col("embedding").cast("array<double>")
    fine = F.coalesce(F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(vec, lambda v: v != 0), F.lit(False))
    good = vectors.filter(F.col("vec_id").isNotNull() & fine).select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
    good = scratch.write(good.groupBy("vec_id").agg(F.min("vec").alias("vec")), "vectors")
    lengths = good.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = lengths["dim"], lengths["count"]
    good = good.filter(F.size("vec") == dim)
    asked = good.filter(queries)
    others = good.filter(F.expr(f"not coalesce(({queries}), false)"))
    fitted = good if others.isEmpty() else others
    sample = np.array([r["vec"] for r in fitted.orderBy(F.xxhash64("vec_id", F.lit(9)), "vec_id").limit(SAMPLE).select("vec").collect()])
    distinct = np.unique(sample, axis=0)
    c = balanced_centroids(sample, max(1, min(MOST_LISTS, total // LIST, len(distinct))))
    made = pa.schema([("list", pa.int32()), ("vec_id", pa.int64()), ("vec", pa.list_(pa.float64()))])
    kind = "list int, vec_id long, vec array<double>"
    filed = scratch.write(good.mapInArrow(_file(c, made), kind), "filed")
    counts = {r["list"]: r["count"] for r in filed.groupBy("list").count().collect()}  # at most MOST_LISTS rows
    sizes = np.array([counts.get(i, 0) for i in range(len(c))])
    first, parts = parts_of(sizes)
    places = spark.createDataFrame([(i, int(first[i]), int(parts[i])) for i in range(len(c))], "list int, first long, parts int")
    filed = filed.join(F.broadcast(places), "list").withColumn("part", F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).drop("first", "parts")
    made = pa.schema([("part", pa.int64()), ("lists", pa.list_(pa.int32())), ("vec_id", pa.int64()), ("vec", pa.list_(pa.float64()))])
    asked = scratch.write(asked.mapInArrow(_probe(c, sizes, made), "part long, lists array<int>, vec_id long, vec array<double>"), "asked")
    turns = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / ASKED).cast("int").alias("turns"))
    turns = F.broadcast(turns) if first[-1] + parts[-1] <= FEW_PARTS else turns
    filed = filed.join(turns, "part").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1))).drop("turns")
    asked = asked.join(turns, "part").withColumn("turn", F.pmod(F.xxhash64("vec_id", F.lit(4)), F.col("turns")).cast("int")).drop("turns")
    found = filed.groupBy("part", "turn").cogroup(asked.groupBy("part", "turn")).applyInArrow(_search(k, dim), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
