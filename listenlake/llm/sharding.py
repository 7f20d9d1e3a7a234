"""Sharding of indivisible groups by best-fit-decreasing bin packing."""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_pandas, running, small_table, stored, with_fields

# Small groups are first packed into parcels of this fraction of a shard, many tasks at a time;
# at most 2 x shards x PARCELS_PER_SHARD + partitions parcels are then packed into shards.
PARCELS_PER_SHARD = 512


@dataclass(slots=True)
class _Node:
    """A bin in the tree, keyed by what it can still take; priorities keep the tree balanced (a treap)."""

    key: tuple[int, int]
    priority: float
    left: _Node | None = None
    right: _Node | None = None


def _merge(low: _Node | None, high: _Node | None) -> _Node | None:
    if low is None or high is None:
        return low or high
    if low.priority < high.priority:
        low.right = _merge(low.right, high)
        return low
    high.left = _merge(low, high.left)
    return high


def _split(node: _Node | None, key: tuple[int, int]) -> tuple[_Node | None, _Node | None]:
    """Nodes below ``key``, and the others."""
    if node is None:
        return None, None
    if node.key < key:
        node.right, high = _split(node.right, key)
        return node, high
    low, node.left = _split(node.left, key)
    return low, node


def _pop_least(node: _Node) -> tuple[_Node, _Node | None]:
    if node.left is None:
        return node, node.right
    least, node.left = _pop_least(node.left)
    return least, node


class BestFit:
    """Bins of one capacity; each item enters the bin that it leaves with the least room."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.n_bins = 0
        self._root: _Node | None = None
        self._random = random.Random(0)

    def add(self, size: int) -> int:
        """The bin that takes an item of ``size``; an item above the capacity has a bin to itself."""
        low, high = _split(self._root, (size, -1))
        if high is None:
            node, self.n_bins = _Node((self.capacity, self.n_bins), self._random.random()), self.n_bins + 1
        else:
            node, high = _pop_least(high)
        room, bin_no = node.key
        self._root = _merge(low, high)
        if room > size:
            node.key, node.left, node.right = (room - size, bin_no), None, None
            low, high = _split(self._root, node.key)
            self._root = _merge(_merge(low, node), high)
        return bin_no


def best_fit_decreasing(sizes: Iterable[int], capacity: int) -> tuple[list[int], int]:
    """Bin of each item, in the order given, and the number of bins of ``capacity``."""
    sizes = list(sizes)
    bins, packing = [0] * len(sizes), BestFit(capacity)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        bins[i] = packing.add(sizes[i])
    return bins, packing.n_bins


def even_bins(sizes: list[int], n_bins: int) -> list[int]:
    """Bins 0 to ``n_bins`` - 1 of the least common capacity for which best-fit-decreasing needs no more.

    Items larger than an even share can't be divided: each has a bin to itself, and the rest is
    spread evenly over the other bins.
    """
    bins, free, total = [0] * len(sizes), n_bins, sum(sizes)
    rest = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    while rest and free > 1 and sizes[rest[0]] * free > total:
        free -= 1
        bins[rest[0]] = free
        total -= sizes[rest[0]]
        rest = rest[1:]
    kept = [sizes[i] for i in rest]
    low, high = max([-(-total // free), *kept[:1]]), max(total, 1)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if best_fit_decreasing(kept, middle)[1] <= free else (middle + 1, high)
    for i, b in zip(rest, best_fit_decreasing(kept, low)[0], strict=True):
        bins[i] = b
    return bins


def _parcels(capacity: int):
    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packing = BestFit(capacity)
        for rows in parts:
            bins = [packing.add(int(size)) for size in rows["bytes"]]
            yield rows.assign(bin=pd.Series(bins, index=rows.index, dtype="int64"))

    return pack


def shard_groups(items: DataFrame, shards: int, parcels_per_shard: int = PARCELS_PER_SHARD) -> DataFrame:
    """``items`` (columns ``group`` and ``size``, any others) with ``shard``: 0 to ``shards`` - 1, bytes near equal.

    Rows of one group are never parted. Sizes are summed per group before anything moves. Each
    partition packs its groups, largest first, into parcels of a fixed capacity; parcels then
    are the indivisible items of a second packing into shards, for which the least capacity that
    needs no more than ``shards`` bins is searched. A group larger than a parcel is a parcel, and
    one larger than an even share has a shard to itself. ``size`` must not be null; null groups
    count as one. Empty input gives no rows.
    """
    spark = items.sparkSession
    groups = stored(items.groupBy("group").agg(F.sum("size").alias("bytes")), "groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    capacity = max(1, total // (shards * parcels_per_shard))
    dealt = groups.repartition("group").sortWithinPartitions(F.desc("bytes"), "group")
    dealt = dealt.withColumn("part", F.spark_partition_id())
    packed = stored(map_pandas(dealt, _parcels(capacity), with_fields(dealt, "bin long")), "parcels")
    parcels = packed.groupBy("part", "bin").agg(F.sum("bytes").alias("bytes")).collect()
    parcels.sort(key=lambda p: (p.part, p.bin))
    chosen = even_bins([p.bytes for p in parcels], shards)
    place = small_table(
        spark, [(p.part, p.bin, s) for p, s in zip(parcels, chosen, strict=True)], "part int, bin long, shard int"
    )
    placed = packed.join(place, ["part", "bin"]).select(F.col("group").alias("_group"), "shard")
    return items.join(placed, F.col("group").eqNullSafe(F.col("_group"))).drop("_group")


def numbered_shards(items: DataFrame, order: list[str]) -> DataFrame:
    """Rows with an int ``shard``, with ``slot`` 0, 1, ... inside each shard, by ``order``."""
    rows = running(items.withColumns({"key": F.col("shard"), "amount": F.lit(0).cast("long")}), order, "slots")
    return rows.withColumnRenamed("rank", "slot").drop("key", "amount", "before")


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """All rows of ``docs`` (doc_id, text) dealt to shards by law ``bytes``; equal texts stay together.

    A row weighs the UTF-8 bytes of its text (null: none) plus 1. Null and empty text are one
    group. Repeated rows and rows without id keep their number; ties in id are ordered by text
    digest. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    items = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
    )
    placed = shard_groups(stored(items, "items"), shards)
    return numbered_shards(placed, ["doc_id", "group"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
