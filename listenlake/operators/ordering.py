"""Placing rows in one total order over many tasks.

``in_order`` range-partitions and sorts: the tasks ("chunks") follow each
other in the order, and no key, however frequent, has to fit in one of them,
because the range bounds are drawn over the full order and not over the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listenlake.operators.scratch import materialise

POSITION = "_position"

# Rows of a group that one task may gather.
LARGE = 20_000

# monotonically_increasing_id() puts the partition number above bit 33 and the
# row number inside the partition below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def in_order(frame: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_position``, increasing along ``order`` (ascending, NULLs first) but with gaps.

    The rows must differ in ``order``. The bounds are sampled anew on every
    execution, so materialise the result before reading it twice.
    """
    return (
        frame.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(POSITION, F.monotonically_increasing_id())
    )


def chunk_of(position: Column) -> Column:
    return F.shiftright(position, _ROW_BITS)


def row_in_chunk(position: Column) -> Column:
    return position.bitwiseAND(F.lit(_ROW_MASK))


def dense_keys(frame: DataFrame, order: Sequence[str], key: str, start: int = 0) -> DataFrame:
    """Add ``key`` = ``start`` + rank (1, 2, ... without gaps) of the row along ``order``.

    Equal to ``row_number() over (order by ...)`` for rows that differ in
    ``order``, without its single task. Only the row count of each chunk, at
    most one number per shuffle partition, comes to the driver.
    """
    placed = materialise(in_order(frame, order), f"keys-{key}")
    chunk = chunk_of(F.col(POSITION))
    counts = {row["chunk"]: row["n"] for row in placed.groupBy(chunk.alias("chunk")).agg(F.count("*").alias("n")).collect()}
    sizes = [counts.get(i, 0) for i in range(max(counts, default=0) + 1)]
    before = accumulate(sizes[:-1], initial=start)
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<bigint>")
    rank = F.get(offsets, chunk.cast("int")) + row_in_chunk(F.col(POSITION)) + 1
    return placed.withColumn(key, rank).drop(POSITION)


def large_groups(frame: DataFrame, group: Sequence[str], large: int = LARGE) -> DataFrame | None:
    """The groups of more than ``large`` rows, which no task should gather; None if there are none.

    There are at most rows / ``large`` of them, so ``of_groups`` broadcasts them.
    """
    sizes = frame.groupBy(*[F.col(g).alias(f"_{g}") for g in group]).agg(F.count("*").alias("_rows"))
    found = materialise(sizes.filter(F.col("_rows") > large).drop("_rows"), "large")
    return None if found.isEmpty() else found


def of_groups(frame: DataFrame, listed: DataFrame, group: Sequence[str], keep: bool = True) -> DataFrame:
    """Rows of the groups that ``large_groups`` found, or, without ``keep``, all others."""
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    return frame.join(F.broadcast(listed), same, "left_semi" if keep else "left_anti")


def number_within(
    frame: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    column: str,
    sized_like: DataFrame | None = None,
    large: int = LARGE,
) -> DataFrame:
    """Add ``column`` = 0, 1, 2, ... along ``order`` inside each ``group``.

    Groups of up to ``large`` rows are numbered in windows, which move the rows once, and not at
    all if a join has dealt them by a part of ``group``. Larger ones are ranked without gathering
    them (``_number_large``). Which these are is counted in ``sized_like`` (default: ``frame``): a
    cheaper table with groups of about the same sizes will do, as it only chooses the way.
    """
    listed = large_groups(frame if sized_like is None else sized_like, group, large)
    if listed is None:
        return _number_small(frame, group, order, column)
    small, rest = (of_groups(frame, listed, group, keep) for keep in (False, True))
    return _number_small(small, group, order, column).unionByName(_number_large(rest, group, order, column))


def _number_small(frame: DataFrame, group: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    number = F.row_number().over(W.partitionBy(*group).orderBy(*order)) - 1
    return frame.withColumn(column, number.cast("bigint"))


def _number_large(frame: DataFrame, group: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    """The same for groups of any size.

    Ranks all rows by (group, order) and subtracts the first rank of the
    group, so a group is never gathered in one task. The first ranks are stored
    before they are joined: Spark then knows their size, and can split a large
    group, which it cannot while the join shares the shuffle of the aggregation.
    """
    rank, first = "_rank", "_first"
    ranked = dense_keys(frame, [*group, *order], rank)
    per_group = ranked.groupBy(*[F.col(g).alias(f"_{g}") for g in group]).agg(F.min(rank).alias(first))
    firsts = materialise(per_group, "firsts")
    same = [ranked[g].eqNullSafe(firsts[f"_{g}"]) for g in group]
    return (
        ranked.join(firsts, same, "left")
        .withColumn(column, F.col(rank) - F.col(first))
        .select(*frame.columns, column)
    )


def highest_key(frame: DataFrame, key: str) -> int:
    """Largest key in use, 0 for an empty table: where new keys continue."""
    return frame.agg(F.max(key)).first()[0] or 0
