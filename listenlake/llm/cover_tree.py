"""Exact top-k inner products by dual-tree search over cover trees."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.llm.common import map_pandas

LEAF = 48
# Rows that one tree holds; a task takes its rows through trees of this size in turn.
TREE_ROWS = 4096
# Queries that are sent to the tasks at once; more are answered in further passes.
QUERY_BLOCK = 4096


@dataclass
class Node:
    """Points within ``radius`` of ``center``; each child holds those within half of it of its own center."""

    center: int
    radius: float
    points: np.ndarray
    children: list[Node] = field(default_factory=list)
    norm: float = 0.0
    summary: tuple[np.ndarray, ...] | None = None  # centers, radii and norms of the children, and which are leaves


def cover_tree(vectors: np.ndarray, leaf: int = LEAF) -> Node:
    """A cover tree: children cover their points within half the radius, and their centers lie further apart than that."""
    norms = np.linalg.norm(vectors, axis=1)

    def node(center: int, points: np.ndarray, distance: np.ndarray) -> Node:
        return Node(center, float(distance.max()), points, norm=float(norms[center]))

    every = np.arange(len(vectors))
    root = node(0, every, np.linalg.norm(vectors - vectors[0], axis=1))
    stack = [root]
    while stack:
        top = stack.pop()
        if len(top.points) <= leaf or top.radius == 0:
            continue
        left, center = top.points, top.center  # the first child keeps its parent's center
        while len(left):
            distance = np.linalg.norm(vectors[left] - vectors[center], axis=1)
            near = distance <= top.radius / 2
            top.children.append(node(center, left[near], distance[near]))
            left = left[~near]
            if len(left):
                center = int(left[0])
        stack.extend(top.children)
    return root


def _inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where these hold all sums, else in unbounded integers."""
    largest = np.abs(q).max(initial=0.0) * np.abs(x).max(initial=0.0) * max(1, q.shape[1])
    if largest < 2.0**53:
        return (q @ x.T).astype(np.int64)
    whole = lambda a: np.array([[int(v) for v in row] for row in a], dtype=object).reshape(a.shape)
    return (whole(q) @ whole(x).T).astype(np.int64)  # an overflow of 64 bits is an error


def _bounds(center: np.ndarray, node: Node, vectors: np.ndarray, parent: Node) -> tuple[np.ndarray, np.ndarray]:
    """For each child of ``parent``, what no product of its points with those of ``node`` exceeds; and which are leaves."""
    if parent.summary is None:
        found = [(c.center, c.radius, c.norm, not c.children) for c in parent.children]
        parent.summary = tuple(map(np.array, zip(*found, strict=True)))
    centers, radius, norm, flat = parent.summary
    product = vectors[centers] @ center
    bound = product + node.radius * norm + radius * node.norm + radius * node.radius
    return bound + 1e-9 * (np.abs(bound) + node.norm * norm) + 1e-6, flat


class DualTreeSearch:
    """The best ``k`` candidates of each query so far; candidates come a tree at a time."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.ids, self.vectors, self.k = ids, vectors, k
        self.tree = cover_tree(vectors)
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min, dtype=np.int64)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max, dtype=np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Search both trees together; a pair of nodes is dropped when even its bound is below every kth score of the queries.

        A product is at most that of the centers, and what the radii allow on top. The bounds of
        all children of a node are taken at once; of the points in those that remain, the most
        promising come first and raise the kth scores for the others.
        """
        width = max(vectors.shape[1], self.vectors.shape[1])
        queries, points = (np.pad(a, ((0, 0), (0, width - a.shape[1]))) for a in (self.vectors, vectors))
        stack = [(np.inf, self.tree, cover_tree(points))]
        while stack:
            bound, q, x = stack.pop()
            if bound < self.scores[q.points, -1].min():
                continue
            if q.children and (not x.children or x.radius <= 4 * q.radius):
                bounds, _ = _bounds(points[x.center], x, queries, q)
                stack.extend((bounds[i], q.children[i], x) for i in np.argsort(bounds))
            elif not x.children:
                self._compare(q.points, ids[x.points], queries, points[x.points])
            else:
                bounds, leaves = _bounds(queries[q.center], q, points, x)
                order = np.flatnonzero(bounds >= self.scores[q.points, -1].min())
                order = order[np.argsort(-bounds[order])]
                flat = leaves[order]
                stack.extend((bounds[i], q, x.children[i]) for i in order[~flat][::-1])
                order = order[flat]
                if q.children:
                    stack.extend((bounds[i], q, x.children[i]) for i in order[::-1])
                    continue
                for at in range(0, len(order), LEAF):
                    part = order[at : at + LEAF]
                    part = part[bounds[part] >= self.scores[q.points, -1].min()]
                    if not len(part):
                        break
                    rows = np.concatenate([x.children[i].points for i in part])
                    self._compare(q.points, ids[rows], queries, points[rows])

    def _compare(self, at: np.ndarray, ids: np.ndarray, queries: np.ndarray, points: np.ndarray) -> None:
        scores = _inner(queries[at], points)
        own = self.ids[at][:, None] == ids[None, :]
        scores = np.where(own, np.iinfo(np.int64).min, scores)
        better = scores.max(axis=1) >= self.scores[at, -1]
        at, scores = at[better], scores[better]
        if not len(at):
            return
        found = np.where(own[better], np.iinfo(np.int64).max, np.broadcast_to(ids, scores.shape))
        scores = np.concatenate([self.scores[at], scores], axis=1)
        found = np.concatenate([self.found[at], found], axis=1)
        order = np.lexsort((found, ~scores), axis=1)[:, : self.k]  # ~ falls as the score rises
        self.scores[at] = np.take_along_axis(scores, order, axis=1)
        self.found[at] = np.take_along_axis(found, order, axis=1)

    def rows(self) -> pd.DataFrame:
        real = self.found != np.iinfo(np.int64).max
        query = np.broadcast_to(self.ids[:, None], self.found.shape)
        return pd.DataFrame({"query_id": query[real], "vec_id": self.found[real], "score": self.scores[real]})


def _matrix(rows: list) -> np.ndarray:
    """Vectors of any lengths as rows of one matrix: shorter ones end in zeros."""
    width = max((len(r) for r in rows), default=0)
    if all(len(r) == width for r in rows):
        return np.array(list(rows), dtype=float).reshape(len(rows), width)
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def _search(ids: np.ndarray, vectors: np.ndarray, k: int):
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = DualTreeSearch(ids, vectors, k)
        for rows in parts:
            for at in range(0, len(rows), TREE_ROWS):
                part = rows.iloc[at : at + TREE_ROWS]
                search.add(part["vec_id"].to_numpy(), _matrix(part["v"].tolist()))
        yield search.rows()

    return run


def whole_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): components floor(``scale`` x) of every vector without null or non-finite components."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c * float(scale)).cast("double"))
    return vectors.filter(F.col("vec_id").isNotNull() & x.isNotNull() & good).select("vec_id", scaled.alias("v"))


def top_products(vectors: DataFrame, is_query: str, k: int = 10, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` largest inner products of each query with all other rows: query_id, rank, vec_id, score.

    ``vectors`` has vec_id and v (whole numbers as doubles); ``is_query`` is a condition on
    vec_id. Ties go to the smaller vec_id; rows of the query's own id are no candidates. Queries
    go to the tasks in blocks of about ``query_block``, a pass over the vectors for each, so
    that what is sent is bounded. Each task indexes its vectors and the block in cover trees and
    keeps the best it has met; the bests of all tasks are then ranked.

    Vectors of different lengths are compared as if the shorter ended in zeros. Repeated query
    ids are answered once, for the largest of their vectors; repeated candidates stand apart.
    No queries, or no vectors, give no rows.
    """
    spark = vectors.sparkSession
    queries = vectors.filter(is_query)
    blocks = max(1, -(-queries.count() // query_block))
    result = spark.createDataFrame([], "query_id long, vec_id long, score long")
    for block in range(blocks):
        rows: dict[int, list[float]] = {}
        for row in queries.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect():
            rows[row.vec_id] = max(rows.get(row.vec_id, row.v), row.v)
        if rows:
            ids = np.array(sorted(rows), dtype=np.int64)
            found = map_pandas(vectors, _search(ids, _matrix([rows[i] for i in ids]), k), result.schema)
            result = result.unionByName(found)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = result.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
