"""Near-duplicate groups by SuperMinHash signatures, banding and verification on full sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_arrow, stored
from listenlake.llm.components import components

SHINGLE_WORDS = 5
SIMILARITY_PERCENT = 75
# 32 bands of 4: a pair of similarity 0.75 shares no band once in 190,000 times.
BANDS = 32
BAND_ROWS = 4
REGISTERS = BANDS * BAND_ROWS
# Longs of a parity sketch, 64 bits each.
SKETCH_LONGS = 32
# Ids of documents to verify up to this number (16 MB) are broadcast; more are joined by shuffle.
BROADCAST_IDS = 2_000_000
# Rows of members outside the largest groups of their bands, with their sketches, up to this number (12 MB) are
# broadcast to the other members; more are joined by shuffle.
BROADCAST_SKETCHES = 40_000
# Texts are hashed in stretches of about so many bytes, which bounds a worker's memory.
BYTES_AT_ONCE = 1 << 20
# Most texts whose signatures are drawn together; fewer if they have more bytes than that.
TEXTS_AT_ONCE = 256

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_EMPTY = np.uint64((1 << 64) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64: a one-to-one scrambling of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LETTERS = _mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = _mix(np.arange(101, 101 + SHINGLE_WORDS, dtype=np.uint64) * _GOLD) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            factors = np.full(2 * n, _BASE, dtype=np.uint64)
            factors[0] = 1
            self.up = np.multiply.accumulate(factors)
            factors[1:] = pow(_BASE, -1, 1 << 64)
            self.down = np.multiply.accumulate(factors)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def _word_hashes(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each word of ``blob``, whose upper-case A-Z are made lower-case."""
    codes = np.frombuffer(blob.lower(), dtype=np.uint8)  # bytes.lower() changes A-Z alone
    solid = ~_BLANK[codes]
    edges = np.flatnonzero(np.diff(solid, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers.upto(len(codes))
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_LETTERS[codes] * up, out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def _long_word_hashes(blob: bytes) -> np.ndarray:
    """Words of a text of any size, hashed in stretches that end at blanks."""
    parts, at = [], 0
    while at < len(blob):
        end = at + BYTES_AT_ONCE
        while end < len(blob) and not _BLANK[blob[end]]:
            end += 1
        parts.append(_word_hashes(blob[at:end])[0])
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def _shingles(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles; of the whole text if it has fewer words."""
    n = len(words)
    if n == 0:
        return words
    if n < SHINGLE_WORDS:
        return _mix((words * _PLACES[:n]).sum(keepdims=True) + np.uint64(n))
    total = np.zeros(n - SHINGLE_WORDS + 1, dtype=np.uint64)
    for k in range(SHINGLE_WORDS):
        total += words[k : n - SHINGLE_WORDS + 1 + k] * _PLACES[k]
    total = _mix(total + np.uint64(SHINGLE_WORDS))
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def _sets(blobs: list[bytes]) -> Iterator[np.ndarray]:
    """The shingle set of each text; short texts are hashed together."""
    at = 0
    while at < len(blobs):
        end, size = at, 0
        while end < len(blobs) and (end == at or size + len(blobs[end]) <= BYTES_AT_ONCE):
            size += len(blobs[end]) + 1
            end += 1
        if end - at == 1:
            yield _shingles(_long_word_hashes(blobs[at]))
        else:
            words, starts = _word_hashes(b" ".join(blobs[at:end]))
            offsets = np.cumsum([len(b) + 1 for b in blobs[at:end]])
            for part in np.split(words, np.searchsorted(starts, offsets))[: end - at]:
                yield _shingles(part)
        at = end


def super_minhash(sets: list[np.ndarray], registers: int = REGISTERS) -> np.ndarray:
    """SuperMinHash signatures (one row of ``registers`` numbers per set) of sets of distinct hashes.

    Every element draws a random permutation of the registers, one place more in each round
    (Fisher-Yates), and offers round + random fraction to the register drawn. A register keeps
    the least offer, which is from the first round that reaches it; so a set is done, and stops
    drawing, as soon as a round leaves it no empty register. Rounds run for all sets at once.
    Values hold the round in the upper and the fraction in the lower 32 bits.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.full(len(sets) * registers, _EMPTY, dtype=np.uint64)
    element = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    row = np.repeat(np.arange(len(sets)), sizes)
    drawn: list[tuple[np.ndarray, np.ndarray]] = []  # places of the first rounds, and what was put there
    dense = None
    for j in range(registers):
        if not len(element):
            break
        random = _mix(element + np.uint64((j + 1) * int(_GOLD) & 0xFFFFFFFFFFFFFFFF))
        offer = (random >> np.uint64(32)) | (np.uint64(j) << np.uint64(32))
        k = j + (((random & np.uint64(0xFFFFFFFF)) * np.uint64(registers - j)) >> np.uint64(32)).astype(np.int64)
        if dense is None and j >= 4:
            dense = np.tile(np.arange(registers, dtype=np.int16), (len(element), 1))
            for i, (place, value) in enumerate(drawn):
                dense[np.arange(len(element)), place] = value
            drawn = []
        if dense is None:
            register, mine = k.copy(), np.full(len(element), j)
            for place, value in drawn:
                register = np.where(place == k, value, register)
                mine = np.where(place == j, value, mine)
            drawn.append((k, mine))
        else:
            at = np.arange(len(element))
            register = dense[at, k].astype(np.int64)
            dense[at, k] = dense[at, j]
        np.minimum.at(flat, row * registers + register, offer)
        undone = (flat.reshape(-1, registers) == _EMPTY).any(axis=1)
        go = undone[row]
        if not go.all():
            element, row = element[go], row[go]
            drawn = [(place[go], value[go]) for place, value in drawn]
            dense = dense[go] if dense is not None else None
    return flat.reshape(-1, registers)


def _band_hashes(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(len(signatures), BANDS, BAND_ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * _GOLD
    for k in range(BAND_ROWS):
        total = _mix(total + parts[:, :, k])
    return total.view(np.int64)


def _blobs(column: pa.Array) -> list[bytes]:
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of (id, text) in turn, few enough for one pass over all their words: one alone if its text is long."""
    sizes = [size or 0 for size in pc.binary_length(batch.column(1)).to_pylist()]
    at = total = 0
    for i, size in enumerate(sizes):
        if i > at and (i - at == TEXTS_AT_ONCE or total + size > BYTES_AT_ONCE):
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += size
    if at < len(sizes):
        yield batch.slice(at)


def parity_sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Of each set, whether an odd or even number of its elements falls on each of some thousand bits.

    Every element that only one of two sets has turns one bit over. So the sketches of two sets
    never differ in more bits than the sets differ in elements.
    """
    bits = 64 * SKETCH_LONGS
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    element = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    cell = row * bits + (_mix(element + _GOLD) % np.uint64(bits)).astype(np.int64)
    odd = (np.bincount(cell, minlength=len(sets) * bits) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(sets), bits), axis=1).view(np.int64)


_SIGNED = "doc_id long, n_shingles long, set_low long, set_high long, bands array<long>, sketch array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text: size of its set, two numbers that tell sets apart, and its bands."""
    names = ["doc_id", "n_shingles", "set_low", "set_high", "bands", "sketch"]
    for batch in batches:
        for part in _parts(batch):
            sets = list(_sets(_blobs(part.column(1))))
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            low = np.array([s.sum() if len(s) else 0 for s in sets], dtype=np.uint64)
            high = np.array([_mix(s ^ _GOLD).sum() if len(s) else 0 for s in sets], dtype=np.uint64)
            bands = _band_hashes(super_minhash(sets))
            offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
            columns = [
                part.column(0),
                pa.array(sizes),
                pa.array(low.view(np.int64)),
                pa.array(high.view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands[sizes > 0].ravel())),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1, dtype=np.int32) * SKETCH_LONGS),
                    pa.array(parity_sketches(sets).ravel()),
                ),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _parts(batch):
            sets = list(_sets(_blobs(part.column(1))))
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, dtype=np.int64)
            rows = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([part.column(0), rows], names=["id", "shingles"])


def _near_in_size(percent: int):
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _verified(docs: DataFrame, pairs: DataFrame, percent: int, broadcast_ids: int) -> DataFrame:
    """Of ``pairs`` (a, b), those whose full sets are similar enough; only texts that stand in a pair are read into sets."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "verify-ids")
    if ids.count() <= broadcast_ids:
        ids = F.broadcast(ids)
    texts = docs.join(ids, "doc_id", "left_semi").select("doc_id", "text")
    sets = stored(map_arrow(texts, _set_rows, "id long, shingles array<long>"), "shingle-sets")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    joined = F.size("sa") + F.size("sb") - common
    return both.filter(common * 100 >= joined * percent).select("a", "b").distinct()


# What names a set of shingles; an id with several texts stands in several classes.
CLASS_KEY = ["set_low", "set_high", "n_shingles"]


def _with_sketches(open_: DataFrame, signed: DataFrame) -> DataFrame:
    """Rows of ``open_`` with the sketch of their own set, also where other texts of the id have as many shingles."""
    wanted = open_.select("doc_id").distinct()
    sketches = signed.select("doc_id", *CLASS_KEY, "sketch").join(wanted, "doc_id", "left_semi")
    sketches = stored(sketches.dropDuplicates(["doc_id", *CLASS_KEY]), "sketches")
    return open_.join(sketches, ["doc_id", *CLASS_KEY])


def near_duplicates(
    docs: DataFrame, percent: int = SIMILARITY_PERCENT, broadcast_ids: int = BROADCAST_IDS
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when their sets of five-word shingles overlap by ``percent`` of their
    union or more; component_id is the smallest doc_id reachable by links.

    1. Every text is read once into a SuperMinHash signature. Equal sets are one class, named by
       its smallest id, and go on as one row.
    2. Classes that share a band are compared with the band's smallest class: one pair per
       member and band, however many members there are.
    3. When the groups of these links are known, members of a band outside its largest group are
       held against members of other groups. Of these pairs only those leave the join whose
       parity sketches allow the similarity: a sketch never shows two sets more different than
       they are, so no link is lost, and dissimilar members of a large band make no rows.
    4. Each pair is verified on full sets.

    Ids name documents: rows without id are linked with nothing (component_id null, kept true),
    and rows of one id stay together, also with different texts. Null or blank text has an
    empty set and is linked with nothing. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(map_arrow(rows, _sign, _SIGNED), "signatures")
    real = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    key = CLASS_KEY
    classes = stored(real.groupBy(*key).agg(F.min("doc_id").alias("class_id")), "classes")

    members = signed.drop("sketch").join(classes, key).filter("doc_id = class_id").dropDuplicates(["doc_id", *key])
    banded = members.select("doc_id", *CLASS_KEY, F.posexplode("bands").alias("band", "value"))
    shared = banded.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("doc_id").alias("hub")).filter("n > 1")
    in_band = stored(
        banded.join(shared, ["band", "value"]).select("band", "value", "hub", "doc_id", *CLASS_KEY), "bands"
    )
    hubs = in_band.filter("hub = doc_id").select("band", "value", F.col("n_shingles").alias("na"))
    stars = (
        in_band.filter("hub <> doc_id")
        .withColumnRenamed("n_shingles", "nb")
        .join(hubs, ["band", "value"])
        .filter(_near_in_size(percent))
        .select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
        .distinct()
    )
    links = stored(_verified(rows, stored(stars, "star-pairs"), percent, broadcast_ids), "links")
    grouped = stored(components(links), "groups")

    placed = in_band.join(grouped, F.col("doc_id") == F.col("node"), "left").select(
        "band", "value", "hub", "doc_id", *CLASS_KEY, F.coalesce("component", "doc_id").alias("component")
    )
    placed = stored(placed, "placed")
    counts = placed.groupBy("band", "value", "component").agg(F.count("*").alias("n"))
    largest = counts.groupBy("band", "value").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.count("*").alias("groups"),
        F.sum("n").alias("members"),
    )
    # The band's smallest class has been compared with all others already.
    several = largest.filter("groups > 1 AND members > 2").select("band", "value", "main")
    open_ = stored(placed.filter("doc_id <> hub").join(several, ["band", "value"]), "open")
    sketched = _with_sketches(open_, signed)

    def side(name: str) -> DataFrame:
        return sketched.select(
            "band",
            "value",
            F.col("doc_id").alias(name),
            F.col("n_shingles").alias(f"n{name}"),
            F.col("component").alias(f"c{name}"),
            F.col("main").alias(f"main_{name}"),
            *[F.get("sketch", F.lit(i)).alias(f"{name}{i}") for i in range(SKETCH_LONGS)],
        )

    differ = sum((F.bit_count(F.col(f"a{i}").bitwiseXOR(F.col(f"b{i}"))) for i in range(SKETCH_LONGS)), F.lit(0))
    # Sets that overlap by p percent of their union differ by (100 - p) / (100 + p) of their sizes.
    may_link = differ * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent)
    outside = side("a").filter("ca <> main_a")
    if open_.filter("component <> main").count() <= BROADCAST_SKETCHES:
        outside = F.broadcast(outside)
    rest = (
        side("b")
        .join(outside, ["band", "value"])
        .filter(F.expr("ca <> cb AND (cb = main_b OR a < b)") & _near_in_size(percent) & may_link)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    more = stored(_verified(rows, stored(rest, "rest-pairs"), percent, broadcast_ids), "more-links")
    # Ids with several texts belong to several classes.
    sets = F.struct(*key)
    twice = real.groupBy("doc_id").agg(F.min(sets).alias("least"), F.max(sets).alias("most")).filter("least <> most")
    twice = stored(twice.select("doc_id"), "twice")
    # The groups stand for the links that made them.
    edges = grouped.select(F.col("component").alias("a"), F.col("node").alias("b")).union(more)
    if not twice.isEmpty():
        same_id = real.join(classes, key).filter("doc_id <> class_id").join(twice, "doc_id", "left_semi")
        edges = edges.union(same_id.select(F.col("class_id").alias("a"), F.col("doc_id").alias("b")))
    final = stored(components(edges), "components")

    known = signed.join(classes, key, "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    found = known.join(final, F.col("class_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that of the smallest id, whole and unchanged.

    Rows without id, and all rows of an id that stays, are kept.
    """
    gone = near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("_near_id")).distinct()
    gone = stored(gone, "near-gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"] == gone["_near_id"], "left_anti")
