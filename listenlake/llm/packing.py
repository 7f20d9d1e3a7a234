"""Best-fit packing of tokenised documents by bin completion."""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_arrow, map_pandas, running, stored, with_fields

SEQUENCE_TOKENS = 2048
# Search steps of the branch and bound; when they are used up, the best solution so far stands.
SEARCH_NODES = 3_000
# Steps in which the fillings of one node are enumerated, up to the first without waste or all of them, before they
# are sorted by waste.
FILLING_STEPS = 200
# Distinct words whose ids a task remembers (some 200 bytes each); it then starts anew.
REMEMBERED_WORDS = 300_000

Pattern = tuple[tuple[int, int], ...]  # (length, how often), longest first
Solution = list[tuple[Pattern, int]]  # pattern, number of sequences


# --- the packing problem: how many pieces there are of each length ----------------------


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs (the bound of Martello and Toth over all thresholds)."""
    number = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        number[length] = count
    upto = np.concatenate([[0], np.cumsum(number)])  # pieces shorter than i
    tokens = np.concatenate([[0], np.cumsum(number * np.arange(capacity + 1))])
    half, best = capacity // 2, -(-int(tokens[-1]) // capacity)
    for least in range(half + 1):
        alone = upto[-1] - upto[capacity - least + 1]
        large, large_tokens = upto[capacity - least + 1] - upto[half + 1], tokens[capacity - least + 1] - tokens[half + 1]
        small_tokens = tokens[half + 1] - tokens[least]
        over = small_tokens - (large * capacity - large_tokens)
        best = max(best, int(alone + large + max(0, -(-over // capacity))))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> Solution:
    """Best-fit-decreasing over counted lengths: equal sequences are filled together."""
    open_: dict[int, list[tuple[dict[int, int], int]]] = {capacity: []}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, kinds in open_.items() if r >= length and kinds), default=capacity)
            kind, times = open_[room].pop() if open_.get(room) else ({}, -(-left // (capacity // length)))
            each = room // length
            filled = min(times, left // each)
            parts = [(each, filled), (left - each * filled, 1 if filled < times and left % each else 0)]
            for copies, n in parts:
                if n and copies:
                    now = {**kind, length: copies}
                    open_.setdefault(room - copies * length, []).append((now, n))
                    left -= copies * n
                    times -= n
            if kind and times:
                open_[room].append((kind, times))
    return [(tuple(sorted(kind.items(), reverse=True)), n) for kinds in open_.values() for kind, n in kinds]


def fillings(lengths: list[int], left: dict[int, int], room: int, steps: Iterator[int]) -> Iterator[tuple[dict[int, int], int]]:
    """Undominated ways to fill ``room``, longest pieces first, each with the room it wastes.

    A filling is dominated if it has room for one more piece, or for a longer piece in place of
    one of its own: what then stands there can take the place of what stood there before. The
    enumeration ends when ``steps`` are used up.
    """
    ascending = lengths[::-1]
    if left.get(room):  # one piece that fills the room exactly dominates all else
        yield {room: 1}, 0
        return

    def undominated(chosen: dict[int, int], waste: int) -> bool:
        # Whether some piece left is as short as the waste, or longer than a chosen one by no more than it.
        if not waste:
            return True
        for start in (0, *chosen):
            at = bisect_left(ascending, start + 1)
            while at < len(ascending) and ascending[at] <= start + waste:
                if left[ascending[at]] > chosen.get(ascending[at], 0):
                    return False
                at += 1
        return True

    def extend(at: int, chosen: dict[int, int], free: int) -> Iterator[tuple[dict[int, int], int]]:
        if next(steps, None) is None:
            return
        while at < len(lengths) and (lengths[at] > free or not left[lengths[at]]):
            at += 1
        if at == len(lengths):
            if undominated(chosen, free):
                yield dict(chosen), free
            return
        length = lengths[at]
        for copies in range(min(left[length], free // length), -1, -1):
            if copies:
                chosen[length] = copies
            else:
                chosen.pop(length, None)
            yield from extend(at + 1, chosen, free - copies * length)

    yield from extend(0, {}, room)


def complete_bins(
    counts: dict[int, int], capacity: int, allowed: int, nodes: int, filling_steps: int = FILLING_STEPS
) -> tuple[Solution | None, bool]:
    """Branch and bound for a packing into at most ``allowed`` sequences.

    Returns the packing, if one is found, and whether the question is settled: with a packing it
    is; without one, only if the whole tree was searched, not if ``nodes`` or the steps for the
    fillings of a node ran out.

    The longest piece left is completed by each of its undominated fillings, least waste first,
    for as many sequences as the counts allow, then for one. A branch ends when its waste
    exceeds what ``allowed`` sequences may waste.
    """
    may_waste = allowed * capacity - sum(length * n for length, n in counts.items())
    if may_waste < 0:
        return None, True
    left, solution, whole = dict(counts), [], True
    order = sorted(counts, reverse=True)

    def choices(wasted: int) -> Iterator[tuple[Pattern, int, int]]:
        nonlocal whole
        longest = next(length for length in order if left[length])
        left[longest] -= 1
        lengths = [x for x in order if x <= capacity - longest and left[x]]
        steps = iter(range(filling_steps))
        all_fillings = fillings(lengths, left, capacity - longest, steps)

        def options(found: list[tuple[dict[int, int], int]]) -> Iterator[tuple[Pattern, int, int]]:
            for filling, waste in sorted(found, key=lambda f: f[1]):
                pattern = dict(filling)
                pattern[longest] = pattern.get(longest, 0) + 1
                times = min(left[length] // n for length, n in pattern.items())
                if waste:
                    times = min(times, (may_waste - wasted) // waste)
                for n in dict.fromkeys((times, 1)):
                    yield tuple(sorted(pattern.items(), reverse=True)), waste, n

        # The first filling without waste is tried before the others are looked for.
        exact, found = None, []
        for filling, waste in all_fillings:
            if waste == 0:
                exact = (filling, 0)
                break
            if wasted + waste <= may_waste:
                found.append((filling, waste))
        left[longest] += 1
        if exact:
            yield from options([exact])
            # Back here all that was taken since has been put back: the enumeration goes on where it stopped.
            left[longest] -= 1
            found += [f for f in all_fillings if wasted + f[1] <= may_waste]
            left[longest] += 1
        whole = whole and next(steps, None) is not None
        yield from options(found)

    stack = [(choices(0), 0)]
    for _ in range(nodes):
        if not stack:
            return None, whole
        options, wasted = stack[-1]
        option = next(options, None)
        if option is None:
            stack.pop()
            if solution:
                for length, n in solution[-1][0]:
                    left[length] += n * solution[-1][1]
                solution.pop()
            continue
        pattern, waste, times = option
        for length, n in pattern:
            left[length] -= n * times
        solution.append((pattern, times))
        if not any(left.values()):
            return solution, True
        stack.append((choices(wasted + waste * times), wasted + waste * times))
    return None, False


def solve(counts: dict[int, int], capacity: int, nodes: int = SEARCH_NODES) -> Solution:
    """As few sequences of ``capacity`` as the search finds for so many pieces of each length.

    The best-fit packing is the first incumbent; bin completion then looks for packings between
    the lower bound and the incumbent, halving the gap. A number that the search cannot settle
    with the ``nodes`` steps left is no bound: the next one is tried nearer to the incumbent, and
    what stands in the end is the best packing found, the least there is if every number was
    settled. There are at most ``capacity`` lengths, so the problem has the same size for any corpus.
    """
    counts = {length: n for length, n in counts.items() if n}
    if not counts:
        return []
    incumbent = best_fit(counts, capacity)
    low, high = lower_bound(counts, capacity), sum(n for _, n in incumbent)
    while low < high:
        middle = (low + high) // 2
        better, _ = complete_bins(counts, capacity, middle, nodes)
        if better is None:
            low = middle + 1  # not packed into so few: proven or given up
        else:
            incumbent, high = better, sum(n for _, n in better)
    return incumbent


# --- tokens ---------------------------------------------------------------------------


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class TokenBytes:
    """Ids of a stretch without blanks as little-endian 32-bit numbers.

    The tokenizer never joins what white space parts, so a text's ids are those of its
    stretches in turn; a stretch is encoded when first met. Nor does it join a letter and a
    full stop or comma: words of plain Latin letters, the bulk of new stretches, go to its merges
    directly, which gives the same ids at a quarter of the cost.
    """

    def __init__(self, tokenizer_path: str) -> None:
        self.ids: dict[str, bytes] = {}
        self._tokenizer = _tokenizer(tokenizer_path)
        self._letters = _byte_letters()
        self._reset()

    def _reset(self) -> None:
        self.ids.clear()
        self._learn_by_text(["", ".", ","])

    def _learn_by_text(self, stretches: list[str]) -> None:
        for stretch, found in zip(
            stretches, self._tokenizer.encode_batch_fast(stretches, add_special_tokens=False), strict=True
        ):
            self.ids[stretch] = struct.pack(f"<{len(found.ids)}I", *found.ids)

    def _learn_words(self, words: set[str]) -> None:
        tokens = self._tokenizer.model.tokenize
        every: list[int] = []
        sizes: list[int] = []
        for word in words:
            spelt = word if word.isascii() else "".join([self._letters[b] for b in word.encode()])
            found = [t.id for t in tokens(spelt)]
            every += found
            sizes.append(4 * len(found))
        packed, at = struct.pack(f"<{len(every)}I", *every), 0
        for word, size in zip(words, sizes, strict=True):
            self.ids[word] = packed[at : at + size]
            at += size

    def learn(self, stretches: set[str]) -> None:
        """Encode those of ``stretches`` that are new; afterwards all of them are there."""
        if len(self.ids) > REMEMBERED_WORDS:
            self._reset()
        ids = self.ids
        ends = {mark: ids[mark] for mark in ".,"}
        plain, other = [], []
        for stretch in stretches.difference(ids):
            end = ends.get(stretch[-1])
            word = stretch if end is None else stretch[:-1]
            if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
                plain.append((stretch, word.lower(), end))
            else:
                other.append(stretch)
        self._learn_words({lower for _, lower, _ in plain}.difference(ids))
        for stretch, lower, end in plain:
            ids[stretch] = ids[lower] if end is None else ids[lower] + end
        self._learn_by_text(other)


_BLANKS = re.compile(r"[ \t\n\r\x0b\x0c]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")  # split() takes them for white space, the tokenizer does not


def _stretches(text: str) -> list[str]:
    return _BLANKS.split(text) if _SEPARATORS.search(text) else text.split()


def token_bytes(text: str, words: TokenBytes) -> bytes:
    stretches = _stretches(text)
    words.learn(set(stretches))
    return b"".join(map(words.ids.__getitem__, stretches))


def _cut(tokenizer_path: str, capacity: int, end_id: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = TokenBytes(tokenizer_path)
        end = struct.pack("<I", end_id)
        # Hundreds of thousands of remembered words, none in a cycle: looking for cycles would take a third of the time.
        gc.disable()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = token_bytes(text.as_py() or "", words) + end
                for piece, at in enumerate(range(0, len(tokens), 4 * capacity)):
                    part = tokens[at : at + 4 * capacity]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        column.append(value)
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=NAMES)

    def without_collector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from pieces(batches)
        finally:
            gc.enable()

    return without_collector


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE_TOKENS, end_id: int = 0) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``capacity``: doc_id, piece, start, length, ids_crc32."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return map_arrow(
        texts,
        _cut(tokenizer_path, capacity, end_id),
        f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long",
    )


# --- places ---------------------------------------------------------------------------


def _layout(solution: Solution) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, by rank among its equals: first rank, copies in a sequence, first sequence, offset."""
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for pattern, times in solution:
        offset = 0
        for length, copies in pattern:
            found.setdefault(length, []).append((ranks.get(length, 0), copies, first, offset))
            ranks[length] = ranks.get(length, 0) + copies * times
            offset += copies * length
        first += times
    return {length: tuple(np.array(rows, dtype=np.int64).T) for length, rows in found.items()}


def _placed(layout: dict[int, tuple[np.ndarray, ...]]):
    def place(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in parts:
            sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            ranks = rows["rank"].to_numpy()
            for length, at in rows.groupby("length").indices.items():
                first_rank, copies, first, start = layout[length]
                k = np.searchsorted(first_rank, ranks[at], side="right") - 1
                nth = ranks[at] - first_rank[k]
                sequence[at] = first[k] + nth // copies[k]
                offset[at] = start[k] + nth % copies[k] * length
            yield rows.assign(sequence_id=sequence, offset=offset)

    return place


def pack_pieces(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, nodes: int = SEARCH_NODES) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Only the number of pieces of each length, at most ``capacity`` figures, reaches the driver,
    where the packing is solved; pieces are ranked among their equals over the cluster, and the
    rank tells a piece its place. Ties are broken by doc_id, piece and checksum; equal rows
    get places of their own. Empty input gives no rows.
    """
    pieces = stored(pieces, "pieces")
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}
    layout = _layout(solve(counts, capacity, nodes))
    keyed = pieces.withColumns({"key": F.col("length").cast("int"), "amount": F.lit(0).cast("long")})
    ranked = running(keyed, ["doc_id", "piece", "ids_crc32"], "ranked-pieces").select(*pieces.columns, "rank")
    return map_pandas(ranked, _placed(layout), with_fields(ranked, "sequence_id long, offset long")).drop("rank")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """All rows of ``docs`` (doc_id, text) packed into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Null text counts as empty, which is one end token. Rows without id and repeated rows are
    packed like others. Whole texts are encoded; only documents above ``capacity`` are cut, and
    their full pieces are sequences of their own. Other columns are ignored.
    """
    return pack_pieces(token_pieces(docs, tokenizer_path, capacity), capacity)
