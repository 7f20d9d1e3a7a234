"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_pandas, stored

# Edges that a task writes in a round, at least if there are so many: few edges make few tasks, whatever the session deals.
EDGES_A_TASK = 200_000
# Smallest neighbours of the nodes of up to so many edges (16 MB) are broadcast to the edges; more are joined by shuffle.
BROADCAST_EDGES = 500_000
# Nodes that a task reduces at once, which bounds its memory.
NODES_AT_ONCE = 500_000


def _union_find(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A partition's edges as (smallest node that they join it to, node), some ``NODES_AT_ONCE`` nodes at a time."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent[top] != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def forest() -> pd.DataFrame:
        nodes = [x for x in parent if parent[x] != x]
        return pd.DataFrame({"a": [root(x) for x in nodes], "b": nodes}, dtype="int64")

    for rows in parts:
        for a, b in zip(rows["a"].tolist(), rows["b"].tolist(), strict=True):
            low, high = sorted((root(parent.setdefault(a, a)), root(parent.setdefault(b, b))))
            parent[high] = low
        if len(parent) > NODES_AT_ONCE:
            yield forest()
            parent.clear()
    yield forest()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: longs): the smallest node that it is joined to.

    Each partition, as the edges lie, first reduces them by union-find to one edge per node, so
    that no node's edges must come together. Then nodes are
    joined to their smallest neighbour, larger ones and smaller ones in turn (large-star and
    small-star), until nothing changes: the edges are then stars around the smallest nodes.
    Neighbours are never gathered; a node with very many is split by the adaptive join. Rounds
    on few edges take few tasks: what a round costs goes by its edges, not by the session's partitions.
    """
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    stars = stored(map_pandas(edges, _union_find, "a long, b long"), "stars")
    seen = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
        n = state[0]
        tasks = max(1, n // EDGES_A_TASK)

        def beside(least: DataFrame) -> DataFrame:
            return F.broadcast(least.coalesce(tasks)) if n <= BROADCAST_EDGES else least

        both = stars.union(stars.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(beside(least), "u").filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))
        large = stored(large.distinct().coalesce(tasks), "stars")
        # Every edge now leads from a node b to a smaller one: a and the others go to the smallest.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(beside(least), "b").select(F.col("m"), F.explode(F.array("a", "b")).alias("v"))
        small = small.filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        stars = stored(small.coalesce(tasks), "stars")
    linked = stars.select(F.col("b").alias("node"), F.col("a").alias("component"))
    roots = stars.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return linked.union(roots.coalesce(tasks))
