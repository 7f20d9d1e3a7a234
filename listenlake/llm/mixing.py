"""Mixing sources to target weights along a curriculum."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import WORD, map_pandas, running, small_table, stored, with_fields

# A source is read at most this many times over.
MAX_PASSES = 3

# Knots (time, factor) of a source's weight over training, 0 to 1; linear between knots, with
# mean 1 so that the share over the whole run stays the source's weight. Heavy sources lead
# the run, light ones gain towards its end.
Schedule = Sequence[tuple[float, float]]
EARLY: Schedule = ((0.0, 1.5), (1.0, 0.5))
EVEN: Schedule = ((0.0, 1.0), (1.0, 1.0))
LATE: Schedule = ((0.0, 0.5), (1.0, 1.5))


def cycled(rank: int) -> tuple[float, Schedule]:
    """Weight and schedule of a source by its place in code point order: 5, 2, 1, 5, ..."""
    return ((5.0, EARLY), (2.0, EVEN), (1.0, LATE))[rank % 3]


def targets(sizes: list[int], weights: list[float], budget: float, limit: float = MAX_PASSES) -> list[float]:
    """``budget`` shared by weight, no share above ``limit`` times its size; the excess is reshared by weight."""
    shares, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(budget)
    while open_:
        per_weight = left / sum(weights[i] for i in open_)
        full = [i for i in sorted(open_) if weights[i] * per_weight > limit * sizes[i]]
        if not full:
            for i in open_:
                shares[i] = weights[i] * per_weight
            break
        for i in full:
            shares[i] = float(limit * sizes[i])
            left -= shares[i]
            open_.remove(i)
    return shares


def training_time(schedule: Schedule, demand: np.ndarray) -> np.ndarray:
    """When a source's demand so far, as a fraction of its target, is reached: the inverse of the integrated schedule."""
    t, w = np.array(schedule, dtype=float).T
    areas = np.concatenate([[0.0], np.cumsum(np.diff(t) * (w[1:] + w[:-1]) / 2)])
    wanted = np.clip(demand, 0.0, 1.0) * areas[-1]
    k = np.clip(np.searchsorted(areas, wanted, side="right") - 1, 0, len(t) - 2)
    slope = (w[k + 1] - w[k]) / (t[k + 1] - t[k])
    over = wanted - areas[k]
    # w x + slope x^2 / 2 = over, solved without cancellation.
    root = np.sqrt(np.maximum(w[k] ** 2 + 2 * slope * over, 0.0))
    return t[k] + np.where(over > 0, 2 * over / np.maximum(w[k] + root, 1e-300), 0.0)


def _schedules_applied(plan: list[tuple[int, float, Schedule]]):
    """Training times of each copy of a document, from where its words lie in its source's demand."""
    of = {key: (size, target, schedule) for key, size, target, schedule in plan}

    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            times: list[list[float]] = [[]] * len(rows)
            for key, at in rows.groupby("key").indices.items():
                size, target, schedule = of[key]
                middle = rows["before"].to_numpy()[at] + rows["size"].to_numpy()[at] / 2
                copies = rows["copies"].to_numpy()[at]
                starts = np.concatenate([[0], np.cumsum(copies)])
                nth = np.arange(starts[-1]) - np.repeat(starts[:-1], copies)
                demand = (np.repeat(middle, copies) + nth * size) / target if target else np.zeros(starts[-1])
                found = training_time(schedule, demand)
                for i, row in enumerate(at):
                    times[row] = found[starts[i] : starts[i + 1]].tolist()
            yield rows.assign(positions=pd.Series(times, index=rows.index, dtype=object))

    return place


def mixing_plan(
    docs: DataFrame, weigh: Callable[[int], tuple[float, Schedule]] = cycled, limit: int = MAX_PASSES
) -> DataFrame:
    """What the mix takes of each row of ``docs`` (doc_id, text, source), and when.

    Returns doc_id, text_hash, size, source, source_size, target, taken (words, repeats counted)
    and positions (ascending training times between 0 and 1, one per copy taken).

    The whole run reads as many words as the corpus has. Sources, by code point with null last,
    get ``weigh(rank)``: a weight and a schedule. A source is read whole as often as its target
    allows and then once more in part: in the order of a hash of the id, the documents whose
    middle word comes before the target. The words of a source therefore miss its target by half
    a document at most, and no document is taken more than ``limit`` times. The n-th word of a
    source is due when its integrated schedule reaches n of its target.

    Words are runs of anything but blanks and tab to carriage return; null text has none. Rows
    without words are taken with their neighbours, at no cost. Ties in hash fall to id, size and
    text hash; rows repeated in everything are separate rows. The driver holds one row per
    source, as it does the weights. No source is held by one task. Other columns are ignored.
    """
    spark = docs.sparkSession
    sized = docs.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64("text").alias("text_hash"),
    )
    sized = stored(sized, "sizes")
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r.source is None, r.source or ""))
    weights = [weigh(rank) for rank in range(len(found))]
    sizes = [r["size"] for r in found]
    shares = targets(sizes, [w for w, _ in weights], sum(sizes), limit)
    sources = small_table(
        spark,
        [(k, r.source, r["size"], shares[k]) for k, r in enumerate(found)],
        "key int, of_source string, source_size long, target double",
    )
    keyed = sized.join(sources, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
    ordered = keyed.withColumns({"amount": F.col("size"), "mix_order": F.xxhash64("doc_id")})
    ranked = running(ordered, ["mix_order", "doc_id", "size", "text_hash"], "mixed")
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    part = F.col("target") - F.col("whole") * F.col("source_size")
    copies = F.col("whole") + F.when(F.col("before") + F.col("size") / 2 < part, 1).otherwise(0)
    taken = ranked.withColumn("whole", whole.cast("int")).withColumn("copies", copies.cast("int"))
    taken = taken.withColumn("taken", F.col("copies") * F.col("size")).drop("whole", "rank", "amount", "mix_order")
    timed = map_pandas(taken, _schedules_applied([(k, sizes[k], shares[k], weights[k][1]) for k in range(len(found))]),
        with_fields(taken, "positions array<double>"),
    )
    return timed.drop("key", "before", "copies")


def mixed_documents(docs: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` in training order, repeated as the mix takes them, with their columns alone.

    Rows are sorted over the whole output by range partitions of their training time; ties fall
    to the id. Rows equal in id and text are taken alike, as the least of their plans has it.
    """
    plan = mixing_plan(docs) if plan is None else plan
    due = plan.filter(F.size("positions") > 0).groupBy("doc_id", "text_hash").agg(F.min("positions").alias("positions"))
    # The rows travel as one column, so that no name of theirs can clash with those used here.
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("row.text") == F.col("text_hash"))
    taken = rows.join(due, same).select("row", F.explode("positions").alias("position"))
    return taken.repartitionByRange("position", "row.doc_id").sortWithinPartitions("position", "row.doc_id").select("row.*")


def in_training_order(plan: DataFrame) -> DataFrame:
    """``plan`` sorted over the whole output by the first position of each row, rows that are not taken last."""
    order = [F.get("positions", F.lit(0)).asc_nulls_last(), F.col("doc_id"), F.col("text_hash")]
    return plan.repartitionByRange(*order).sortWithinPartitions(*order)
