"""Runs of an unchanged state along an ordered history, per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from listenlake.operators.ordering import POSITION, chunk_of, in_order, row_in_chunk
from listenlake.operators.scratch import materialise

_CHUNK = "_chunk"
_SEGMENT = "_segment"
_FIRST = "_first"
_LAST = "_last"
_RUN = "_run"

_MERGE = {"min": F.min, "max": F.max, "sum": F.sum}


def state_runs(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    measures: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per run: ``keys``, ``state``, ``run_start``, ``next_start``, measures.

    A run is a longest stretch of rows of one key, along ``order``, with the
    same ``state``; NULL counts as a state of its own. ``run_start`` is the
    value of ``order[0]`` in the first row of the run and ``next_start`` that of
    the key's following run (NULL for its last one). ``measures`` maps an output
    name to ``(function, column)``, the function being min, max or sum.
    The rows must differ in ``keys`` and ``order``.

    A key may hold any share of the rows. Windows see one key inside one chunk of the
    range-partitioned order, and what crosses the chunk borders is settled in tables with one
    row per chunk, which are small enough to broadcast: there are never more chunks than
    shuffle partitions.
    """
    measures = dict(measures or {})
    keys, state = list(keys), list(state)
    segments = materialise(_segments(frame, keys, order, state, measures), "runs")
    borders = materialise(_borders(segments, keys, state), "borders")
    runs = _join_across_chunks(segments, borders, keys, state, measures)

    # The run that follows the last one of a chunk is the first to begin in a later chunk.
    first_begun = (
        segments.join(F.broadcast(borders.select(F.col("_begins").alias(_FIRST))), _FIRST)
        .select(_CHUNK, F.struct(*keys).alias("_key"), "run_start")
        .select(
            _CHUNK,
            F.lead("_key").over(W.orderBy(_CHUNK)).alias("_later_key"),
            F.lead("run_start").over(W.orderBy(_CHUNK)).alias("_later_start"),
        )
    )
    in_chunk = W.partitionBy(_CHUNK, *keys).orderBy(_RUN)
    later = F.when(F.col("_later_key").eqNullSafe(F.struct(*keys)), F.col("_later_start"))
    return (
        runs.withColumn("_is_last", F.lead(F.lit(True)).over(in_chunk).isNull())
        .withColumn("_next", F.lead("run_start").over(in_chunk))
        .join(F.broadcast(first_begun), _CHUNK)
        .withColumn("next_start", F.when(F.col("_is_last"), later).otherwise(F.col("_next")))
        .select(*keys, *state, "run_start", "next_start", *measures)
    )


def gathered_state_runs(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    state: Sequence[str],
    measures: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """The same by windows that gather each key in one task: for keys with few rows.

    Rows move once, and not at all if they are dealt by some of ``keys`` already; nothing is stored.
    """
    measures = dict(measures or {})
    along = W.partitionBy(*keys).orderBy(*order)
    current = F.struct(*state)
    return (
        frame.withColumn("_changed", (~current.eqNullSafe(F.lag(current).over(along))).cast("int"))
        .withColumn(_RUN, F.sum("_changed").over(along.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn(_FIRST, F.row_number().over(along))
        .groupBy(*keys, _RUN, *state)
        .agg(
            F.min_by(order[0], _FIRST).alias("run_start"),
            *[_MERGE[function](column).alias(name) for name, (function, column) in measures.items()],
        )
        .withColumn("next_start", F.lead("run_start").over(W.partitionBy(*keys).orderBy(_RUN)))
        .select(*keys, *state, "run_start", "next_start", *measures)
    )


def _segments(
    frame: DataFrame,
    keys: list[str],
    order: Sequence[str],
    state: list[str],
    measures: dict[str, tuple[str, str]],
) -> DataFrame:
    """Runs cut at the chunk borders, with the positions of their first and last rows."""
    needed = list(dict.fromkeys([*keys, *order, *state, *(column for _, column in measures.values())]))
    here = W.partitionBy(_CHUNK, *keys).orderBy(POSITION)
    current = F.struct(*state)
    return (
        in_order(frame.select(*needed), [*keys, *order])
        .withColumn(_CHUNK, chunk_of(F.col(POSITION)))
        .withColumn("_changed", (~current.eqNullSafe(F.lag(current).over(here))).cast("int"))
        .withColumn(_SEGMENT, F.sum("_changed").over(here.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(_CHUNK, *keys, _SEGMENT, *state)
        .agg(
            F.min(POSITION).alias(_FIRST),
            F.max(POSITION).alias(_LAST),
            F.min_by(order[0], POSITION).alias("run_start"),
            *[_MERGE[function](column).alias(name) for name, (function, column) in measures.items()],
        )
    )


def _borders(segments: DataFrame, keys: list[str], state: list[str]) -> DataFrame:
    """One row per chunk: how its first segment relates to the chunk before.

    ``_carried`` is the position where the run began that reaches into the chunk
    from before (NULL if none does), ``_begins`` that of the first segment in the
    chunk that begins a run.
    """
    identity = F.struct(*keys, *state)
    by_chunk = W.orderBy(_CHUNK)
    opening = segments.filter(row_in_chunk(F.col(_FIRST)) == 0).select(
        _CHUNK, identity.alias("_head"), F.col(_FIRST).alias("_opening"), (F.col(_LAST) + 1).alias("_second")
    )
    last = segments.groupBy(_CHUNK).agg(F.max(_FIRST).alias("_closing"))
    closing = segments.join(F.broadcast(last.select("_closing")), F.col(_FIRST) == F.col("_closing")).select(
        _CHUNK, identity.alias("_tail"), "_closing"
    )
    # The run open at the end of a chunk began at the chunk's last segment, unless
    # that is its only one and continues the chunk before.
    continues = F.col("_head").eqNullSafe(F.lag("_tail").over(by_chunk))
    begun = F.when(~F.col("_continues") | (F.col("_closing") > F.col("_opening")), F.col("_closing"))
    return (
        opening.join(closing, _CHUNK)
        .withColumn("_continues", continues)
        .withColumn("_begun", begun)
        .withColumn("_open_run", F.last("_begun", True).over(by_chunk.rowsBetween(W.unboundedPreceding, 0)))
        .select(
            _CHUNK,
            F.col("_opening"),
            F.when(F.col("_continues"), F.lag("_open_run").over(by_chunk)).alias("_carried"),
            F.when(F.col("_continues"), F.col("_second")).otherwise(F.col("_opening")).alias("_begins"),
        )
    )


def _join_across_chunks(
    segments: DataFrame,
    borders: DataFrame,
    keys: list[str],
    state: list[str],
    measures: dict[str, tuple[str, str]],
) -> DataFrame:
    """Whole runs, each with the chunk (``_chunk``) and position (``_run``) where it begins."""
    # A run has at most one segment per chunk, so nothing is gained by a partial
    # aggregation, and one exchange serves the aggregation and the caller's window.
    return (
        segments.join(F.broadcast(borders.select(F.col("_opening").alias(_FIRST), "_carried")), _FIRST, "left")
        .withColumn(_RUN, F.coalesce("_carried", _FIRST))
        .withColumn(_CHUNK, chunk_of(F.col(_RUN)))
        .repartition(_CHUNK, *keys)
        .groupBy(_CHUNK, *keys, _RUN, *state)
        .agg(
            F.min_by("run_start", _FIRST).alias("run_start"),
            *[_MERGE[function](name).alias(name) for name, (function, _) in measures.items()],
        )
    )
