"""Line de-duplication by winnowing: matches between marks, extended word by word, are deleted where they stand later."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.llm.bloom import Filters, filters_of
from listenlake.llm.common import map_arrow, stored

# A repeated passage has so many words at least.
RUN_WORDS = 50
# Stretches of a third of that are winnowed: of all that lie in one passage of RUN_WORDS, the one of least hash is a mark.
MARK_SHARE = 3
# Lists of up to so many documents and places in all are broadcast to the texts; else both are joined by shuffle.
BROADCAST_DOCS = 200_000
BROADCAST_PLACES = 5_000_000
# Passages whose marks are found at once; places among them fit into the low bits of a number.
PLACE_BITS = 24
AT_ONCE = 1 << 22

_PLACES = "doc_id long, version long, hash long, place int"
# Most marks and spans stand once: all of them go as bytes, which Spark need not take apart, beside their hashes.
_MARK = np.dtype([("hash", "<i8"), ("place", "<i4"), ("low", "<i4"), ("n", "<i4")])
_SPAN = np.dtype([("hash", "<i8"), ("first", "<i4"), ("stop", "<i4")])
_PACKED = "doc_id long, version long, marks binary, spans binary, hashes array<bigint>"
_BORDERS = (
    "doc_id long, version long, marks array<struct<hash:bigint,place:int,low:int,n:int>>, "
    "spans array<struct<hash:bigint,first:int,stop:int>>"
)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = re.compile(r"\S+")


# White space as str.split() has it: these bytes, and these characters beyond ASCII, in UTF-8.
_SPACE = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21)])
_OTHER_SPACE = re.compile("|".join("\x85 \xa0 \u1680 \u2028 \u2029 \u202f \u205f \u3000".split(" ")).encode() + rb"|\xe2\x80[\x80-\x8a]")
_OTHER_HEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
# Numbers for the letters of words, and texts that are hashed at once.
_LETTERS = np.random.default_rng(3).integers(0, 1 << 64, 256, dtype=np.uint64)
BYTES_AT_ONCE = 1 << 18


@lru_cache(maxsize=2)
def _first_powers(base: int) -> np.ndarray:
    out = np.full(2 * BYTES_AT_ONCE, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2, ...: ``n`` of them, the usual ones kept (4 MB a base)."""
    if n <= 2 * BYTES_AT_ONCE:
        return _first_powers(base)[:n]
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _first_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the first place of its least one. Values have 64 - PLACE_BITS bits."""
    found = []
    n = len(values) - width + 1
    for at in range(0, n, AT_ONCE):
        part = values[at : min(at + AT_ONCE, n) + width - 1]
        least, size = (part << np.uint64(PLACE_BITS)) | np.arange(len(part), dtype=np.uint64), 1
        while 2 * size <= width:
            least, size = np.minimum(least[:-size], least[size:]), 2 * size
        if size < width:
            least = np.minimum(least[: len(least) - (width - size)], least[width - size :])
        found.append((least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _blobs(texts: pa.Array) -> Iterator[tuple[bytes, list[int]]]:
    """Texts, each with a blank after it, together as long as they are short, and their lengths with the blanks."""
    group: list[bytes] = []
    size = 0
    for text in texts.cast(pa.binary()).to_pylist():
        text = text or b""
        if not text.isascii() and any(head in text for head in _OTHER_HEADS):
            text = _OTHER_SPACE.sub(b" ", text)
        group.append(text)
        size += len(text) + 1
        if size >= BYTES_AT_ONCE:
            yield b" ".join([*group, b""]), [len(t) + 1 for t in group]
            group, size = [], 0
    if group:
        yield b" ".join([*group, b""]), [len(t) + 1 for t in group]


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(32)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def _word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each word, from differences of a running polynomial of its letters."""
    letters = np.frombuffer(blob, dtype=np.uint8)
    inside = ~_SPACE[letters]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, stops = edges[::2], edges[1::2]
    sums = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_LETTERS[letters] * _powers(_BASE, len(letters)), out=sums[1:])
    shift = _powers(_INVERSE, len(letters))
    return _mixed((sums[stops] - sums[starts]) * shift[starts] + (stops - starts).astype(np.uint64)), starts


class _Words:
    """The words of many texts, laid end to end, by hash; places count through all of them.

    ``begin`` and ``end`` are where each text's words stand. Marks and the passages that they are
    the mark of follow from the words of one text alone, however many others stand around it.
    """

    def __init__(self, texts: pa.Array, least_words: int) -> None:
        self.least = least_words
        self.size = max(least_words // MARK_SHARE, 1)
        hashes, sizes = [], [0]
        for blob, texts_in_it in _blobs(texts):
            found, starts = _word_hashes(blob)
            hashes.append(found)
            ends = np.cumsum(texts_in_it)
            sizes += np.diff(np.searchsorted(starts, ends), prepend=0).tolist()
        hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        borders = np.cumsum(sizes)
        self.begin, self.end = borders[:-1], borders[1:]
        self.text = np.repeat(np.arange(len(texts)), sizes[1:])
        self.sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * _powers(_BASE, len(hashes)), out=self.sums[1:])
        self.shift = _powers(_INVERSE, len(hashes) + 1)

    def stretches(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hashes of stretches of words, from differences of a running polynomial, mixed."""
        return _mixed((self.sums[stop] - self.sums[first]) * self.shift[first] + (stop - first).astype(np.uint64))

    def marks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash and place of each mark, the first passage that it is the mark of, and how many (they follow each other).

        The mark of a passage is the first place of the least of its short stretches.
        """
        first = np.arange(max(0, len(self.text) - self.size + 1))
        short = self.stretches(first, first + self.size)
        place = _first_least(short >> np.uint64(PLACE_BITS), self.least - self.size + 1)
        low = np.flatnonzero(np.arange(len(place)) + self.least <= self.end[self.text[: len(place)]])
        new = np.flatnonzero(np.diff(place[low], prepend=-1))
        n = np.diff(np.append(new, len(low)))
        return short[place[low[new]]], place[low[new]], low[new], n

    def spans(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and stop of the spans between marks; a text's ends are borders as well.

        A span begins at a border and holds every passage that begins before the next one. So
        what two texts share from border to border is cut alike in both, spans tell of long
        matches by few hashes, and no passage inside a match falls between two spans.
        """
        some = np.unique(self.text[places])
        first = np.unique(np.concatenate([places, self.begin[some]]))
        stops = np.unique(np.concatenate([places + self.size, self.end[some]]))
        end = self.end[self.text[first]]
        following = np.minimum(np.append(first[1:], len(self.text)) + self.least - 1, end)
        stop = stops[np.searchsorted(stops, following)] if len(first) else first
        whole = stop - first >= self.least
        return self.stretches(first[whole], stop[whole]), first[whole], stop[whole]


def _passages(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``n`` places each from ``low`` on."""
    return np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())


def _inside(at: np.ndarray, first: np.ndarray, stop: np.ndarray, least_words: int) -> np.ndarray:
    """Which of the passages that begin at ``at`` lie in one of the spans."""
    order = np.argsort(first, kind="stable")
    furthest = np.append(0, np.maximum.accumulate(stop[order])) if len(first) else np.zeros(1, np.int64)
    return furthest[np.searchsorted(first[order], at, side="right")] >= at + least_words


def _lists(owner: np.ndarray, n: int, names: list[str], columns: list[np.ndarray]) -> pa.Array:
    """Rows of structs as a list for each of ``n`` owners, which must come in order; the first column has hashes."""
    offsets = np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)
    arrays = [pa.array(columns[0].view(np.int64)), *(pa.array(c.astype(np.int32)) for c in columns[1:])]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(arrays, names=names))


def _packed(owner: np.ndarray, n: int, kind: np.dtype, columns: list[np.ndarray]) -> pa.Array:
    """Rows of ``kind`` as bytes for each of ``n`` owners, which must come in order; the first column has hashes."""
    rows = np.empty(len(owner), kind)
    for name, column in zip(kind.names, columns, strict=True):
        rows[name] = column.view(np.int64) if name == "hash" else column
    offsets = (np.searchsorted(owner, np.arange(n + 1)) * kind.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _read_borders(least_words: int):
    """The marks of each document and the spans between them, packed, and the hashes of both; none of documents that are too short."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = _Words(batch.column(2), least_words), batch.num_rows
            mark_hashes, places, low, many = words.marks()
            mark_of = words.text[places]
            begin = words.begin[mark_of]
            marks = _packed(mark_of, n, _MARK, [mark_hashes, places - begin, low - begin, many])
            span_hashes, first, stop = words.spans(places)
            span_of = words.text[first]
            begin = words.begin[span_of]
            spans = _packed(span_of, n, _SPAN, [span_hashes, first - begin, stop - begin])
            owner = np.concatenate([mark_of, span_of])
            order = np.argsort(owner, kind="stable")
            hashes = pa.array(np.concatenate([mark_hashes, span_hashes])[order].view(np.int64))
            offsets = pa.array(np.searchsorted(owner[order], np.arange(n + 1)).astype(np.int32))
            columns = [*batch.columns[:2], marks, spans, pa.ListArray.from_arrays(offsets, hashes)]
            rows = pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "marks", "spans", "hashes"])
            yield rows.filter(pa.array(words.end - words.begin >= least_words))

    return read


def _only_repeated(filters):
    """Rows of borders, unpacked, without marks and spans whose hash the filter has not met twice."""

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filters(filters.value)
        for batch in batches:
            columns = list(batch.columns[:2])
            for packed, kind in zip(batch.columns[2:4], (_MARK, _SPAN), strict=True):
                sizes = pc.binary_length(packed).to_numpy(zero_copy_only=False) // kind.itemsize
                rows = np.frombuffer(b"".join(packed.to_pylist()), kind)
                keep = known.flags(rows["hash"].astype(np.int64).view(np.uint64))[0]
                owner, rows = np.repeat(np.arange(len(packed)), sizes)[keep], rows[keep]
                fields = [rows["hash"].astype(np.int64), *(rows[name] for name in kind.names[1:])]
                columns.append(_lists(owner, len(packed), list(kind.names), fields))
            rows = pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:4])
            yield rows.filter(pc.greater(pc.add(pc.list_value_length(columns[2]), pc.list_value_length(columns[3])), 0))

    return only


# Places of different texts are told apart by this distance, which no text reaches.
_APART = 1 << 40


def _flat(lists: pa.Array, *names: str) -> list[np.ndarray]:
    """Owner of each struct of the lists (null ones are empty), and its fields."""
    lists = pc.fill_null(lists, pa.scalar([], lists.type))
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    structs = lists.flatten()
    return [owner, *(structs.field(name).to_numpy(zero_copy_only=False) for name in names)]


def _places(ids: pa.Array, versions: pa.Array, owner: np.ndarray, hashes: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    columns = [ids.take(pa.array(owner)), versions.take(pa.array(owner))]
    columns += [pa.array(hashes.view(np.int64)), pa.array(places.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "version", "hash", "place"])


def _open_marks(least_words: int):
    """Marks (doc_id, version, marks, gone) that are those of a passage in none of the spans that are gone."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, hashes, places, low, n = _flat(batch.column(2), "hash", "place", "low", "n")
            of, first, stop = _flat(batch.column(3), "first", "stop")
            if not len(owner):
                continue
            at = _passages(low.astype(np.int64) + owner * _APART, n)
            inside = _inside(at, first + of * _APART, stop + of * _APART, least_words)
            open_ = np.add.reduceat(inside.astype(np.int64), np.cumsum(n) - n) < n
            yield _places(batch.column(0), batch.column(1), owner[open_], hashes[open_], places[open_])

    return find


def _read_passages(least_words: int):
    """Hash and place of each passage whose mark is among the document's ``places`` and that lies in no span that is gone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = _Words(batch.column(2), least_words)
            _, marks, low, n = words.marks()
            own = batch.column(3)
            owner = np.repeat(np.arange(len(own)), pc.list_value_length(own).to_numpy(zero_copy_only=False))
            wanted = np.isin(marks, own.flatten().to_numpy(zero_copy_only=False) + words.begin[owner])
            at = _passages(low[wanted], n[wanted])
            of, first, stop = _flat(batch.column(4), "first", "stop")
            at = at[~_inside(at, first + words.begin[of], stop + words.begin[of], least_words)]
            text = words.text[at]
            yield _places(batch.column(0), batch.column(1), text, words.stretches(at, at + least_words), at - words.begin[text])

    return read


def _versioned(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("version"), text.alias("text"))


def _beside(lists: DataFrame, columns: list[str], label: str) -> DataFrame:
    """``lists`` stored, and broadcast if its documents and what its list columns hold are few."""
    lists = stored(lists, label)
    held = reduce(lambda a, b: a + b, [F.coalesce(F.array_size(c), F.lit(0)) for c in columns])
    docs, places = lists.agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    return F.broadcast(lists) if docs <= BROADCAST_DOCS and places <= BROADCAST_PLACES else lists


def repeated_runs(docs: DataFrame, least_words: int = RUN_WORDS) -> DataFrame:
    """Stretches of words of ``docs`` (doc_id, text) that stand earlier: doc_id, version, first_word, last_word.

    Words are what white space parts, counted from 0 over all lines of a text. A word belongs to
    a run if some passage of ``least_words`` words around it stands earlier, by doc_id, version
    (a hash of the text) and word, wherever both begin and end: passages cross lines. As every
    passage inside a longer match stands earlier, too, runs are matches extended word by word.

    Equal passages have the same mark, the least hash of their short stretches, so what two texts
    share is cut by marks at the same words. First the spans between marks are compared with
    the first place of their hash: each that stands earlier is gone, and with the next ones makes
    up all of a match but its ends. To extend matches to their ends, the
    passages that lie in no such span are hashed one by one, if their mark has two places or more
    that are left open like this, and compared with the first place of their hash. A passage's
    first place is never inside a span that is gone, or it would not be the first: so none is
    missed. Hashes that stand once are known by a filter of bounded size and go no further.

    Rows of one id and text are one document; rows without id or text have no runs. Runs may
    overlap. Other columns are ignored.
    """
    doc = ["doc_id", "version"]
    rows = _versioned(docs).filter("doc_id IS NOT NULL AND text IS NOT NULL")
    borders = stored(map_arrow(rows, _read_borders(least_words), _PACKED), "line-borders")
    # Not deduplicated by document: rows of one id and text are the same document, whose spans stand once.
    hashes = borders.select(F.explode("hashes").alias("key"))
    often = hashes.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    filters = filters_of(stored(often.select("key", F.lit(True).alias("recent")), "line-often"))
    if filters is None:
        return rows.limit(0).select(*doc, F.lit(0).alias("first_word"), F.lit(0).alias("last_word"))
    shared = docs.sparkSession.sparkContext.broadcast(filters.marks)
    repeated = stored(map_arrow(borders.drop("hashes"), _only_repeated(shared), _BORDERS), "line-repeated").dropDuplicates(doc)

    spans = repeated.select(*doc, F.explode("spans").alias("span")).select(*doc, "span.*")
    start = F.struct(*doc, F.col("first"))
    # First places are stored before they are joined: Spark then knows their size, and splits a hash that is everywhere.
    known = spans.groupBy("hash").agg(F.min(start).alias("earliest"), F.count("*").alias("n")).filter("n > 1")
    gone = spans.join(stored(known.select("hash", "earliest"), "line-earliest"), "hash").filter(start > F.col("earliest"))
    gone = stored(gone.groupBy(*doc).agg(F.collect_list(F.struct("first", "stop")).alias("gone")), "line-gone")

    marked = repeated.filter(F.size("marks") > 0).select(*doc, "marks").join(gone, doc, "left").select(*doc, "marks", "gone")
    open_ = stored(map_arrow(marked, _open_marks(least_words), _PLACES), "line-open")
    twice = stored(open_.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "line-twice")
    places = open_.join(twice, "hash", "left_semi").groupBy(*doc).agg(F.collect_list("place").alias("places"))
    places = _beside(places.join(gone, doc, "left"), ["places", "gone"], "line-places")
    left = rows.join(places, doc).select(*doc, "text", "places", "gone")
    passages = stored(map_arrow(left, _read_passages(least_words), _PLACES), "line-passages")

    here = F.struct(*doc, "place")
    first = passages.groupBy("hash").agg(F.min(here).alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = passages.join(stored(first.select("hash", "first"), "line-first"), "hash").filter(here > F.col("first")).select(*doc, "place")
    # Dealt by document once, for the duplicates of a place and for the runs of it.
    later = later.repartition(*doc).distinct()
    islands = later.withColumn("island", F.col("place") - F.row_number().over(Window.partitionBy(*doc).orderBy("place")))
    runs = islands.groupBy(*doc, "island").agg(F.min("place").alias("first_word"), F.max("place").alias("last_word"))
    ends = runs.select(*doc, "first_word", (F.col("last_word") + (least_words - 1)).alias("last_word"))
    whole = gone.select(*doc, F.explode("gone").alias("run"))
    return ends.unionByName(whole.select(*doc, F.col("run.first").alias("first_word"), (F.col("run.stop") - 1).alias("last_word")))


def _without(text: str, runs: list[tuple[int, int]]) -> tuple[str, list[int], int]:
    """``text`` without the words of ``runs``, the lines that went whole, and the number of words deleted."""
    lines = text.split("\n")
    split = [line.split() for line in lines]
    sizes = [len(words) for words in split]
    n = sum(sizes)
    gone = np.zeros(n + 1, bool)
    for first, last in runs:
        gone[first : last + 1] = True
    before = np.concatenate([[0], np.cumsum(gone)]).tolist()  # words deleted before a word
    stays = (~gone).tolist()
    kept, whole, at = [], [], 0
    for i, (line, size) in enumerate(zip(lines, sizes, strict=True)):
        deleted = before[at + size] - before[at]
        if not size and 0 < at < n and not stays[at - 1] and not stays[at] or size and deleted == size:
            whole.append(i)
        elif not deleted:
            kept.append(line)
        elif " ".join(split[i]) == line.strip():
            kept.append(" ".join(compress(split[i], stays[at : at + size])))
        else:  # other white space stays inside what is kept
            words = [m.span() for m in _WORD.finditer(line)]
            left = [j for j in range(size) if stays[at + j]]
            stretches: list[list[int]] = []
            for j in left:
                if stretches and stretches[-1][1] == j - 1:
                    stretches[-1][1] = j
                else:
                    stretches.append([j, j])
            kept.append(" ".join(line[words[a][0] : words[b][1]] for a, b in stretches))
        at += size
    return "\n".join(kept), whole, int(gone[:n].sum())


def _spell(lines: list[int]) -> str:
    runs: list[list[int]] = []
    for line in lines:
        if runs and runs[-1][1] == line - 1:
            runs[-1][1] = line
        else:
            runs.append([line, line])
    return ",".join(f"{a}-{b}" for a, b in runs)


def _delete(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, text, runs) of texts that have runs, without these."""
    for batch in batches:
        out: list[list] = [[] for _ in range(5)]
        for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            kept, whole, words = _without(text, [(r["first_word"], r["last_word"]) for r in runs])
            row = (kept, text.count("\n") + 1, len(whole), _spell(whole), words)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64())
        columns = [batch.column(0), *(pa.array(c, t) for c, t in zip(out, types, strict=True))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_lines", "n_deleted", "deleted", "words_deleted"])


def drop_repeated_lines(docs: DataFrame, least_words: int = RUN_WORDS) -> DataFrame:
    """Each row of ``docs`` as doc_id, text (without repeated runs), n_lines, n_deleted, deleted, words_deleted.

    A line whose words all go, goes whole, as do empty lines inside a run: n_deleted counts
    these lines, deleted names them as first-last. Of other lines the words outside runs stay.
    Null text stays null with one empty line.
    """
    doc = ["doc_id", "version"]
    runs = repeated_runs(docs, least_words).groupBy(*doc).agg(
        F.array_sort(F.collect_set(F.struct("first_word", "last_word"))).alias("runs")
    )
    own = docs.select(F.col("doc_id").alias("id"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("version", F.xxhash64("text"))
    runs = _beside(runs, ["runs"], "runs").withColumnsRenamed({c: f"_{c}" for c in doc})
    # Null-safe, though runs have no null ids: rows with and without runs then come from the same shuffle or broadcast.
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & F.col("version").eqNullSafe(F.col("_version"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, n_lines long, n_deleted long, deleted string, words_deleted long"
    cut = map_arrow(own.join(runs, same).select("id", "text", "runs"), _delete, schema)
    # Texts that stay whole need no words: only their lines are counted, by Spark.
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    whole = own.join(runs, same, "left").filter("runs IS NULL").select(
        F.col("id").alias("doc_id"),
        "text",
        (F.coalesce(breaks, F.lit(0)) + 1).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_deleted"),
        F.lit("").alias("deleted"),
        F.lit(0).cast("long").alias("words_deleted"),
    )
    return cut.unionByName(whole)
