"""Exact top-k search with dual cover trees.

Vectors and queries are dealt into blocks of bounded size by a hash of
their id; every block of queries meets every block of vectors in one task (a
stated query set against all rows, in blocks).  A task indexes both sides by
cover trees and walks them together: the scores of a pair of nodes
cannot exceed ``cq.cd + rq |cd| + rd |cq| + rq rd`` (centres c, covering radii r),
and the pair is pruned when that is below the worst kth score of the query
node's members.  Node pairs are visited best bound first; leaf pairs are one
matrix product.  Each task returns k rows per query, and a query's lists
merge by rank.

Defined results: null, empty or non-finite vectors take no part, neither do
rows without id; vectors of different length are not compared; equal scores
are ordered by id; repeated rows are separate candidates, rows with the
query's id are never its candidates; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .vectors import first_k, usable

BLOCK, QUERY_BLOCK = 8192, 4096
LEAF, FANOUT = 64, 16


class Node:
    """Points of a subtree (``rows`` of the matrix), centre row and covering radius."""

    __slots__ = ("rows", "centre", "norm", "radius", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: int):
        self.rows, self.centre = rows, points[centre]
        away = np.sqrt(((points[rows] - self.centre) ** 2).sum(1))
        self.norm, self.radius = float(np.sqrt((self.centre ** 2).sum())), float(away.max())
        self.children: list[Node] = []
        if len(rows) > LEAF and self.radius > 0:
            self._split(points, centre, away)

    def _split(self, points: np.ndarray, centre: int, away: np.ndarray) -> None:
        """Farthest points become centres until they cover the node at half its radius.

        There are ``FANOUT`` at most, and no more than full leaves would need.
        """
        rows = self.rows
        most = min(FANOUT, max(2, len(rows) // LEAF))
        centres, owner, least = [centre], np.zeros(len(rows), np.int64), away.copy()
        while len(centres) < most and least.max() > self.radius / 2:
            new = int(least.argmax())
            own = np.sqrt(((points[rows] - points[rows[new]]) ** 2).sum(1))
            owner[own < least] = len(centres)
            least = np.minimum(least, own)
            centres.append(int(rows[new]))
        self.children = [Node(points, rows[owner == i], c) for i, c in enumerate(centres) if (owner == i).any()]


def bound(q: Node, d: Node) -> float:
    """No inner product between the nodes' members is larger (with room for rounding)."""
    top = float(q.centre @ d.centre) + q.radius * d.norm + d.radius * q.norm + q.radius * d.radius
    return top + 1e-9 * (abs(top) + q.norm * d.norm + 1)


class DualSearch:
    """Best k of all points for all queries; state is one sorted list per query."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int):
        self.k, self.ids, self.query_ids = k, ids, query_ids
        self.queries, self.points = queries.astype(np.float64), points.astype(np.float64)
        biggest = lambda m: float(np.abs(m).max(initial=0))
        exact = biggest(self.queries) * biggest(self.points) * points.shape[1] < 2 ** 53
        self._left, self._right = (self.queries, self.points) if exact else (queries.astype(np.int64), points.astype(np.int64))
        kind = np.float64 if exact else np.int64
        self._least = -np.inf if exact else np.iinfo(np.int64).min + 1  # its negative exists
        self.scores = np.full((len(queries), k), self._least, kind)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.leaf_pairs = self.pruned = 0

    def _leaf(self, q: Node, d: Node) -> None:
        self.leaf_pairs += 1
        for lo in range(0, len(d.rows), 4096):
            rows = d.rows[lo:lo + 4096]
            new = self._left[q.rows] @ self._right[rows].T
            new[self.query_ids[q.rows][:, None] == self.ids[rows][None, :]] = self._least
            keen = np.flatnonzero((new >= self.scores[q.rows, -1:]).any(1))
            if not len(keen):
                continue
            at = q.rows[keen]
            scores = np.concatenate([self.scores[at], new[keen]], axis=1)
            ids = np.concatenate([self.found[at], np.broadcast_to(self.ids[rows], (len(at), len(rows)))], axis=1)
            ids = np.where(scores == self._least, np.iinfo(np.int64).max, ids)
            order = np.lexsort((ids, -scores), axis=1)[:, :self.k]
            self.scores[at] = np.take_along_axis(scores, order, 1)
            self.found[at] = np.take_along_axis(ids, order, 1)

    def run(self) -> None:
        q = Node(self.queries, np.arange(len(self.queries)), 0)
        d = Node(self.points, np.arange(len(self.points)), 0)
        heap, n = [(-bound(q, d), 0, q, d)], 0
        while heap:
            top, _, q, d = heapq.heappop(heap)
            if -top < self.scores[q.rows, -1].min():
                self.pruned += 1
                continue
            if not q.children and not d.children:
                self._leaf(q, d)
                continue
            for a in (q.children or [q]):
                for b in (d.children or [d]):
                    n += 1
                    heapq.heappush(heap, (-bound(a, b), n, a, b))


def search(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` best integer inner products among all other rows."""
    vectors = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<long>").alias("v"), is_query.alias("q"), F.size("v").alias("length"))
    vectors, _ = materialize(vectors, "vectors")
    n, asked = vectors.agg(F.count(F.lit(1)), F.sum(F.col("q").cast("long"))).first()
    blocks, groups = -(-n // BLOCK) or 1, -(-(asked or 0) // QUERY_BLOCK) or 1
    spread = lambda m, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(m)).cast("int")
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    right = vectors.select("length", "vec_id", "v", spread(blocks, 1).alias("block"), each(groups).alias("group"))
    left = vectors.where("q").select(F.col("length").alias("qlength"), F.col("vec_id").alias("query_id"), F.col("v").alias("qv"),
                                     each(blocks).alias("qblock"), spread(groups, 2).alias("qgroup"))

    def matrix(t: pa.Table, name: str) -> np.ndarray:
        return t.column(name).combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)

    def run(asked: pa.Table, there: pa.Table) -> pa.Table:
        none = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not asked.num_rows or not there.num_rows:
            return none.empty_table()
        ids, own = there.column("vec_id").to_numpy(), asked.column("query_id").to_numpy()
        dual = DualSearch(matrix(asked, "qv"), own, matrix(there, "v"), ids, k)
        dual.run()
        rows, cols = np.nonzero(dual.scores != dual._least)
        return pa.table({"query_id": own[rows], "vec_id": dual.found[rows, cols], "score": dual.scores[rows, cols].astype(np.int64)}, none)

    found = left.groupBy("qlength", "qblock", "qgroup").cogroup(right.groupBy("length", "block", "group")).applyInArrow(run, "query_id long, vec_id long, score long")
    return first_k(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], k).select(
        "query_id", F.col("place").cast("int").alias("rank"), "vec_id", "score")


def quantize(embeddings: DataFrame, vector_col: str = "embedding", factor: float = 256.0) -> DataFrame:
    """(vec_id, v) with floor(factor * x) for usable vectors."""
    vector = F.col(f"`{vector_col}`")
    return embeddings.where(usable(vector)).select(
        "vec_id", F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(factor)).cast("long")).alias("v"))


def topk_digest(embeddings: DataFrame) -> DataFrame:
    """The contract's columns: ids divisible by 50 ask for their 5 best."""
    return search(quantize(embeddings), F.pmod("vec_id", F.lit(50)) == 0, 5)
