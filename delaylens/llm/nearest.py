"""Approximate nearest neighbours: stable projections, kd-trees, verification until a chi-square test holds.

Largest inner products become smallest distances: with M the largest norm, x goes to (x, sqrt(M^2 - |x|^2)) and a
query q to (q, 0). Gaussian projections to a few dimensions keep distances in law: a squared projected distance is
the true one times a chi-square variable. Neighbours are looked at in order of projected distance; once the next one's
is so large that a point nearer than the current k-th would lie within it with probability ``sure``, the search ends.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from .common import written

DIMS, SURE, TOP = 8, 0.97, 20
#: The cells' borders are fitted on so many vectors, chosen by hash; every vector is indexed. Vectors per cell, most
#: cells, and vectors per leaf of a cell's tree.
SAMPLE, CELL, MOST_CELLS, LEAF = 20_000, 4096, 1 << 14, 32


def chi_square_quantile(p: float, dims: int) -> float:
    """Where the distribution function for an even number of dimensions reaches ``p``."""
    low, high = 0.0, 1000.0
    while high - low > 1e-9:
        x = (low + high) / 2
        below = 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
        low, high = (x, high) if below < p else (low, x)
    return low


def projection(dims: int, seed: int = 11) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((dims + 1, DIMS))


class Cells:
    """A kd-tree over the projected sample; its leaves are the cells that vectors are dealt to."""

    def __init__(self, points: np.ndarray, cells: int):
        self.depth = max(0, math.ceil(math.log2(max(1, cells))))
        self.axis, self.at = np.zeros(1 << self.depth, np.int64), np.full(1 << self.depth, np.inf)
        parts = {1: points}
        for node in range(1, 1 << self.depth):
            own = parts.pop(node, points[:0])
            if len(own):
                self.axis[node] = int(np.ptp(own, axis=0).argmax())
                self.at[node] = np.median(own[:, self.axis[node]])
            right = own[:, self.axis[node]] > self.at[node]
            parts[2 * node], parts[2 * node + 1] = own[~right], own[right]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.ones(len(points), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (points[np.arange(len(points)), self.axis[node]] > self.at[node])
        return node - (1 << self.depth)


class Leaves:
    """The leaves of a balanced kd-tree over one cell, with their boxes."""

    def __init__(self, points: np.ndarray):
        order, todo, ends = np.arange(len(points)), [(0, len(points))], []
        while todo:
            lo, hi = todo.pop()
            if hi - lo <= LEAF:
                ends.append((lo, hi))
                continue
            own, mid = order[lo:hi], (hi - lo) // 2
            axis = int(np.ptp(points[own], axis=0).argmax())
            order[lo:hi] = own[np.argpartition(points[own, axis], mid)]
            todo += [(lo, lo + mid), (lo + mid, hi)]
        self.members = np.full((len(ends), LEAF), -1)
        for i, (lo, hi) in enumerate(ends):
            self.members[i, :hi - lo] = order[lo:hi]
        self.low = np.stack([points[order[lo:hi]].min(axis=0) for lo, hi in ends])
        self.high = np.stack([points[order[lo:hi]].max(axis=0) for lo, hi in ends])


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least squared distance of each point to each box."""
    total = np.zeros((len(points), len(low)))
    for k in range(points.shape[1]):
        x = points[:, k, None]
        total += np.maximum(0, np.maximum(low[None, :, k] - x, x - high[None, :, k])) ** 2
    return total


def search_cell(vectors: np.ndarray, leaves: Leaves, queries: np.ndarray, projected: np.ndarray, bound: np.ndarray,
                most: float, k: int, limit: float, step: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best (scores, places) of each query in a cell; place -1 where there are fewer.

    ``bound`` is the k-th score known from elsewhere. Leaves come in order of projected distance, ``step`` at a time;
    a query ends when its next leaf is farther than the test allows for its k-th distance.
    """
    n, width = len(queries), -(-len(leaves.members) // step) * step
    near = box_distances(projected, leaves.low, leaves.high)
    order = np.argsort(near, axis=1, kind="stable")
    near = np.take_along_axis(near, order, axis=1)
    scores, places = np.full((n, k), -np.inf), np.full((n, k), -1)
    squared = np.einsum("ij,ij->i", queries, queries)
    for at in range(0, width, step):
        if at >= near.shape[1]:
            break
        kth = np.maximum(scores.min(axis=1), bound)
        distance = np.where(np.isfinite(kth), squared + most - 2 * np.where(np.isfinite(kth), kth, 0), np.inf)
        on = np.flatnonzero(near[:, at] < limit * np.maximum(distance, 1e-12))
        if not len(on):
            break
        for part in np.array_split(on, max(1, len(on) // 64)):
            members = leaves.members[order[part, at:at + step]].reshape(len(part), -1)
            found = np.einsum("qd,qpd->qp", queries[part], vectors[members])
            found[members < 0] = -np.inf
            all_scores = np.concatenate([scores[part], found], axis=1)
            best = np.argpartition(-all_scores, k - 1, axis=1)[:, :k]
            scores[part] = np.take_along_axis(all_scores, best, axis=1)
            places[part] = np.take_along_axis(np.concatenate([places[part], members], axis=1), best, axis=1)
    places[~np.isfinite(scores)] = -1
    return scores, places


# --- tables ----------------------------------------------------------------------------------------

def valid_vectors(rows: DataFrame, dims: int) -> DataFrame:
    """``(id, key, vec, norm2)`` of the rows that take part; ``key`` stands for the vector's contents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("v")
            own = pc.and_(pc.is_valid(batch.column("id")), pc.equal(pc.fill_null(pc.list_value_length(column), -1), dims))
            batch = batch.filter(own)
            flat = pc.list_flatten(batch.column("v")).cast(pa.float64())
            ok = ~np.asarray(pc.is_null(flat)).reshape(-1, dims).any(axis=1)
            x = np.asarray(pc.fill_null(flat, 0.0)).reshape(-1, dims)
            ok &= np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            x = x[ok] + 0.0
            vec = [r.tobytes() for r in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").filter(pa.array(ok)), pa.array([hashlib.blake2b(v, digest_size=16).digest() for v in vec], pa.binary()),
                 pa.array(vec, pa.binary()), pa.array(np.einsum("ij,ij->i", x, x))], ["id", "key", "vec", "norm2"])

    return rows.mapInArrow(work, "id long, key binary, vec binary, norm2 double")


def _matrix(column) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


class Space:
    """The projection of vectors and queries."""

    def __init__(self, dims: int, most: float):
        self.matrix, self.most = projection(dims), most

    def vectors(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.most - np.einsum("ij,ij->i", x, x), 0))
        return x @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, x: np.ndarray) -> np.ndarray:
        return x @ self.matrix[:-1]


def _searched(index: DataFrame, asked: DataFrame, space: Broadcast, k: int, sure: float) -> DataFrame:
    """``(query, score, ids)`` from each asked ``(cell, key, vec, bound)`` in its cell of ``index``.

    A task holds the vectors of one cell at a time; the queries pass by in batches.
    """
    limit = chi_square_quantile(sure, DIMS)
    both = index.select("cell", F.lit(0).alias("kind"), "key", "vec", "ids", F.lit(None).cast("double").alias("bound"))
    both = both.union(asked.select("cell", F.lit(1), "key", "vec", F.lit(None).cast("array<long>"), "bound"))
    both = both.repartition("cell").sortWithinPartitions("cell", "kind")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, tree, vectors, ids = None, [], None, None, None
        for batch in batches:
            cell, kind = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
            code = cell * 2 + kind
            cuts = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(lo, hi - lo)
                if cell[lo] != current:
                    current, held, tree = cell[lo], [], None
                if kind[lo] == 0:
                    held.append(part)
                    continue
                if not held and tree is None:
                    continue
                if tree is None:
                    vectors = np.concatenate([_matrix(p.column("vec")) for p in held])
                    ids = [i for p in held for i in p.column("ids").to_pylist()]
                    tree, held = Leaves(space.value.vectors(vectors)), []
                q = _matrix(part.column("vec"))
                bound = np.asarray(pc.fill_null(part.column("bound"), -np.inf))
                scores, places = search_cell(vectors, tree, q, space.value.queries(q), bound, space.value.most, k, limit)
                at, rank = np.nonzero((places >= 0) & (scores >= bound[:, None]))
                own = places[at, rank]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(at)), pa.array(np.einsum("ij,ij->i", q[at], vectors[own])),
                     pa.array([ids[i] for i in own.tolist()], pa.list_(pa.int64()))], ["query", "score", "ids"])

    return both.mapInArrow(work, "query binary, score double, ids array<long>")


def nearest(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", top: int = TOP,
            sure: float = SURE, cell: int = CELL) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for the ids in ``queries`` (column ``key``) the ``top`` vectors of largest
    inner product found, themselves left out; equal scores in order of id.

    Vectors that are NULL, zero, of another than the most frequent length, or hold NULL or non-finite components take
    no part, neither do NULL ids. Equal vectors are searched once, whatever their number. Repeated rows count once.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    sizes = rows.where(F.size("v") > 0).groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = sizes["n"]
    valid = written(valid_vectors(rows, dims), "vectors")
    k = top + 1  # the query itself may be among them
    # a group of equal vectors keeps the ids that can be among the first
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    firsts = valid.select("id", "key").distinct().withColumn("place", place).where(F.col("place") <= k)
    ids = firsts.groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    asked = valid.join(queries.select(F.col(key).alias("id")).distinct(), "id").select("id", "key").distinct()
    known = valid.groupBy("key").agg(F.first("vec").alias("vec")).join(ids, "key").join(
        asked.select("key", F.lit(True).alias("asked")).distinct(), "key", "left")
    known = written(known, "vector-groups")
    most = valid.agg(F.max("norm2")).first()[0]
    if most is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = known.count()
    near = known.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) <= int(min(1, SAMPLE / n) * (1 << 20)))
    local = Space(dims, most)
    sample = [r["vec"] for r in near.select("vec").limit(2 * SAMPLE).collect()]
    points = local.vectors(np.frombuffer(b"".join(sample), np.float64).reshape(len(sample), dims))
    space, cells = spark.sparkContext.broadcast(local), spark.sparkContext.broadcast(
        Cells(points, min(MOST_CELLS, -(-n // cell))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = space.value.vectors(_matrix(batch.column("vec"))) if batch.num_rows else np.zeros((0, DIMS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells.value.of(p)), pa.array(list(p), pa.list_(pa.float64())), *batch.columns],
                ["cell", "p", *batch.schema.names])

    index = written(known.mapInArrow(deal, "cell long, p array<double>, key binary, vec binary, ids array<long>, asked boolean"), "index")
    ends = [f(F.get("p", F.lit(i))).alias(f"{f.__name__}{i}") for f in (F.min, F.max) for i in range(DIMS)]
    found = index.groupBy("cell").agg(*ends).orderBy("cell").collect()  # at most MOST_CELLS rows
    boxes = spark.sparkContext.broadcast(tuple(np.array([[r[f"{f}{i}"] for i in range(DIMS)] for r in found]) for f in ("min", "max"))
                                         + (np.array([r["cell"] for r in found]),))
    queried = index.where("asked").select("cell", "key", "vec")
    # first the nearest cell, whose k-th score then limits the others
    limit = chi_square_quantile(sure, DIMS)

    def routed(first: bool):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            low, high, names = boxes.value
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    part = batch.slice(lo, 256)
                    q = _matrix(part.column("vec"))
                    away = box_distances(space.value.queries(q), low, high)
                    home = away.argmin(axis=1)
                    if first:
                        at, to = np.arange(len(q)), home
                        bound = pa.nulls(len(q), pa.float64())
                    else:
                        kth = np.asarray(pc.fill_null(part.column("bound"), -np.inf))
                        distance = np.where(np.isfinite(kth), np.einsum("ij,ij->i", q, q) + space.value.most
                                            - 2 * np.where(np.isfinite(kth), kth, 0), np.inf)
                        away[np.arange(len(q)), home] = np.inf
                        at, to = np.nonzero((away < limit * np.maximum(distance, 1e-12)[:, None]) & np.isfinite(away))
                        bound = part.column("bound").take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names[to]), part.column("key").take(pa.array(at)), part.column("vec").take(pa.array(at)), bound],
                        ["cell", "key", "vec", "bound"])
        return work

    shape = "cell long, key binary, vec binary, bound double"
    one = written(_searched(index, queried.mapInArrow(routed(True), shape), space, k, sure), "near")
    kth = one.groupBy(F.col("query").alias("key")).agg(
        F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    two = _searched(index, queried.join(kth, "key", "left").mapInArrow(routed(False), shape), space, k, sure)
    hits = one.union(two).select("query", "score", F.explode("ids").alias("vec_id"))
    best = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    hits = hits.withColumn("place", best).where(F.col("place") <= k).drop("place")
    out = asked.withColumnRenamed("id", "query_id").join(hits, F.col("key") == F.col("query")).where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= top)


def digest(embeddings: DataFrame) -> DataFrame:
    """Every vector whose id is divisible by 20 against all rows."""
    return nearest(embeddings.select("vec_id", "embedding"), embeddings.where(F.col("vec_id") % 20 == 0).select("vec_id"))
