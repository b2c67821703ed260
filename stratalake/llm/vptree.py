"""Nearest neighbours by largest inner product, with a vantage-point tree per shard.

Inner products become distances by one more coordinate: with r the largest length in a shard, each vector x gets
sqrt(r*r - x*x) and the query gets 0, so that the squared distance is q*q + r*r - 2*q*x. In such a tree every node has a vantage
point and splits its vectors, by their distance from it, into a nearer and a farther half of known bounds. For a
query the triangle inequality bounds the distance to a half from below; a half is left out if ``factor`` times the bound
exceeds the distance of the k-th neighbour so far. Factor 1 gives exact results, larger ones prune more and may
miss neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a shard: one task holds a shard and its tree. Vectors in a leaf are compared by one matrix product.
SHARD_ROWS, LEAF_ROWS = 8_192, 256
#: Queries that walk a tree together.
QUERY_ROWS = 4_096
#: Rounding of a matrix product: what comes this close to a limit is computed exactly, or not left out.
_SLACK, _DISTANCE_SLACK = 1e-9, 1e-6


@dataclass
class _Part:
    """Either a leaf, or a vantage point with halves and the least and largest distance of each from it."""

    rows: np.ndarray | None = None
    point: int = -1
    halves: tuple[tuple[_Part, float, float], ...] = ()


class Tree:
    """A vantage-point tree over the vectors of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        squares = np.einsum("ij,ij->i", vectors, vectors)
        self.radius2 = float(squares.max())
        self.extra = np.sqrt(np.maximum(self.radius2 - squares, 0))
        self.root = self._split(np.arange(len(ids)))

    def _split(self, rows: np.ndarray) -> _Part:
        if len(rows) <= LEAF_ROWS:
            return _Part(rows=rows)
        point = int(rows[0])
        product = self.vectors[rows] @ self.vectors[point] + self.extra[rows] * self.extra[point]
        distance = np.sqrt(np.maximum(2 * (self.radius2 - product), 0))
        order = np.argsort(distance, kind="stable")
        middle = len(rows) // 2
        halves = tuple(
            (self._split(rows[half]), float(distance[half[0]]), float(distance[half[-1]]))
            for half in (order[:middle], order[middle:])
        )
        return _Part(point=point, halves=halves)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> _Best:
        best = _Best(len(queries), k)
        if len(queries):
            base = np.einsum("ij,ij->i", queries, queries) + self.radius2
            self._visit(self.root, np.arange(len(queries)), query_ids, queries, base, best, factor)
        return best

    def _visit(self, part, active, query_ids, queries, base, best: _Best, factor: float) -> None:
        if part.rows is not None:
            scores = queries[active] @ self.vectors[part.rows].T
            near = scores >= (best.limit[active] - _SLACK)[:, None]
            near &= query_ids[active][:, None] != self.ids[part.rows][None, :]
            q, r = np.nonzero(near)
            if len(q):
                rows = part.rows[r]
                best.add(active[q], self.ids[rows], exact_products(queries[active[q]], self.vectors[rows]))
            return
        distance = np.sqrt(np.maximum(base[active] - 2 * (queries[active] @ self.vectors[part.point]), 0))
        # the half that most of the queries are nearer to goes first
        inner_first = np.mean(distance <= part.halves[0][2]) >= 0.5
        for half, least, most in part.halves if inner_first else part.halves[::-1]:
            bound = np.maximum(np.maximum(least - distance, distance - most), 0)
            farthest = np.sqrt(np.maximum(base[active] - 2 * best.limit[active], 0))
            go = factor * bound <= farthest + _DISTANCE_SLACK
            if go.any():
                self._visit(half, active[go], query_ids, queries, base, best, factor)


class _Best:
    """The k best of each query so far: largest score, then smallest id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.limit = np.full(n, -np.inf)
        self.query, self.id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        touched = np.zeros(len(self.limit), bool)
        touched[query] = True
        old = touched[self.query]
        q = np.concatenate([self.query[old], query])
        i = np.concatenate([self.id[old], ids])
        s = np.concatenate([self.score[old], scores])
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        head = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(head, np.diff(np.append(head, len(q))))
        keep = rank < self.k
        last = rank == self.k - 1
        self.limit[q[last]] = s[last]
        self.query = np.concatenate([self.query[~old], q[keep]])
        self.id = np.concatenate([self.id[~old], i[keep]])
        self.score = np.concatenate([self.score[~old], s[keep]])


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed one component after the other."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _searched(k: int, factor: float):
    """Rows (size, shard, is_query, vec_id, vector) sorted by these: a shard's vectors come before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = None, [], None
        for batch in batches:
            size, shard, asks, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            cuts = np.flatnonzero((np.diff(size) != 0) | (np.diff(shard) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(ids)], strict=True):
                if (size[a], shard[a]) != now:
                    now, held, tree = (size[a], shard[a]), [], None
                part = ids[a:b], _matrix(batch.column(4).slice(a, b - a))
                if not asks[a]:
                    held.append(part)
                    continue
                if tree is None:
                    if not held:
                        continue  # a shard without vectors
                    tree = Tree(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                    held = []
                for at in range(0, b - a, QUERY_ROWS):
                    asking = part[0][at : at + QUERY_ROWS]
                    best = tree.search(asking, part[1][at : at + QUERY_ROWS], k, factor)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(asking[best.query]), pa.array(best.id), pa.array(best.score)],
                        names=["query_id", "vec_id", "score"],
                    )

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    factor: float = 1.0,
    shard_rows: int = SHARD_ROWS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """For each query its ``k`` nearest vectors: query_id, rank (from 1), vec_id, score (inner product in double).

    Nearest first, ties to the smaller vec_id; a query's own id is no candidate; with fewer candidates all are returned.
    Each query visits all shards, of about ``shard_rows`` vectors each, and each shard's k best are merged.

    Vectors and queries that are null, all zero or hold null, NaN or infinite components, and null ids, take no part.
    Only vectors of a query's length are candidates. Of rows that repeat an id the smallest vector counts. Other columns
    are ignored. Without queries or vectors there are no rows.
    """

    def valid(df: DataFrame) -> DataFrame:
        v = F.col("vector")
        fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return (
            df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
            .where(F.col("vec_id").isNotNull() & fine & F.exists(v, lambda x: x != 0))
            .groupBy("vec_id")
            .agg(F.min("vector").alias("vector"))
        )

    spark = vectors.sparkSession
    points, asking = valid(vectors), valid(queries)
    shards = max(1, -(-vectors.count() // shard_rows))
    rows = points.select(
        F.size("vector").alias("size"),
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(False).alias("asks"),
        "vec_id",
        "vector",
    ).union(
        asking.select(
            F.size("vector"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))), F.lit(True), "vec_id", "vector"
        )
    )
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards)
    found = (
        rows.repartition(partitions, "size", "shard")
        .sortWithinPartitions("size", "shard", "asks", "vec_id")
        .mapInArrow(_searched(k, factor), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
