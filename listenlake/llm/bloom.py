"""Bloom filters of bounded size, built over the cluster and sent to its tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_arrow

# A filter has at most so many 64-bit words (8 MB); beyond some eight million keys it lets more
# through, which costs its users work but changes no result.
LEAST_SLOTS, MOST_SLOTS = 1 << 12, 1 << 20
SLOTS_PER_KEY = 0.25
PROBES = 3


def mix(state: np.ndarray, number: np.ndarray) -> np.ndarray:
    """A hash of both; of a sequence, by going on with its next number."""
    mixed = (state ^ number) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(27))


def _places(hashes: np.ndarray, n_slots: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slot and bit of each probe; ``n_slots`` is a power of two."""
    for probe in range(PROBES):
        h = mix(hashes, np.uint64(2 * probe + 1))
        yield ((h >> np.uint64(8)) & np.uint64(n_slots - 1)).astype(np.int64), np.uint64(1) << (h & np.uint64(63))


class Filters:
    """Bloom filters of 64-bit keys, one a plane. They forget no key, and may take others for one."""

    def __init__(self, marks: np.ndarray) -> None:
        self.marks = marks  # planes x slots

    def flags(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones((len(self.marks), len(keys)), dtype=bool)
        for slot, bit in _places(keys, self.marks.shape[1]):
            found &= (self.marks[:, slot] & bit) != 0
        return found


def _mark(n_slots: int):
    """Keys (key, recent) to their marks in the two planes of a filter."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy().view(np.uint64)
            recent = batch.column(1).to_numpy(zero_copy_only=False)
            for slot, bit in _places(keys, n_slots):
                bits = bit.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot), pa.array(bits), pa.array(np.where(recent, bits, 0))], names=["slot", "ever", "recent"]
                )

    return mark


def filters_of(keys: DataFrame) -> Filters | None:
    """The filters of all ``keys`` (key, recent) and of the recent ones; None if there are no recent ones."""
    n, n_recent = keys.agg(F.count("*"), F.coalesce(F.count_if("recent"), F.lit(0))).first()
    if not n_recent:
        return None
    wanted = max(LEAST_SLOTS, int(n * SLOTS_PER_KEY))
    n_slots = min(MOST_SLOTS, 1 << (wanted - 1).bit_length())
    marks = map_arrow(keys, _mark(n_slots), "slot long, ever long, recent long")
    rows = marks.groupBy("slot").agg(F.bit_or("ever").alias("ever"), F.bit_or("recent").alias("recent")).toArrow()
    filled = np.zeros((2, n_slots), dtype=np.uint64)
    slots = rows["slot"].to_numpy()
    for plane, name in enumerate(("ever", "recent")):
        filled[plane, slots] = rows[name].to_numpy().view(np.uint64)
    return Filters(filled)
