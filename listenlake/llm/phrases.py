"""Phrase collocations by dynamic itemset counting over cyclic scans of corpus shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlake.llm.bloom import Filters, filters_of, mix
from listenlake.llm.common import discard, map_arrow, stored

SHARDS = 2
LONGEST = 3
LEAST = 10
TOP = 2000
# A phrase is covered by a longer candidate that has this share of its occurrences, in percent.
COVERED = 50
NO_LANGUAGE = "und"

# Bytes that end a piece, and what a text's bytes become: small letters, blanks between words.
ENDS = b".,;:!?\n\x0b\x0c\r"
_BLANK, _END = ord(" "), ord(".")
_BYTES = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + ENDS, b"abcdefghijklmnopqrstuvwxyz " + bytes([_END]) * len(ENDS)
)

# Words that a scan counts together, and a task of it has at least if there are so many.
WORDS_AT_ONCE = 3_000_000
# Words a task of the first pass remembers to have sent.
REMEMBERED_WORDS = 300_000
DICTIONARY = -1


def _words(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Words of texts: row of each in the list of different words, that list, and the numbers of its piece and text."""
    letters = np.frombuffer(b".".join(texts).translate(_BYTES), dtype=np.uint8)
    ends = letters == _END
    inside = ~(ends | (letters == _BLANK))
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    stops = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters[inside].tobytes())]
    ).dictionary_encode()
    pieces = np.cumsum(ends)[starts] if len(starts) else starts
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    return words.indices.to_numpy(zero_copy_only=False), words.dictionary.to_pylist(), pieces, text


def _code_type(n: int) -> type:
    """What holds the codes of ``n`` different words."""
    return np.uint16 if n < 1 << 16 else np.int32


def _encode(seed: int):
    """Texts (text, lang, shard) to codes of words, one row a language and shard, 0 between pieces; and to the words.

    Code 1 is the first of a row's ``numbers``, the numbers of its different words. Both go as
    bytes, which pass through Spark uncounted, while elements of arrays are copied one by one.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            row, different, pieces, text = _words(batch.column(0).cast(pa.binary()).to_pylist())
            if not len(row):
                continue
            numbers = [xxhash.xxh64_intdigest(word, seed) for word in different]
            signed = np.array(numbers, dtype=np.uint64).view(np.int64)
            rows: list[tuple] = []
            keys = list(zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True))
            group, groups = pd.factorize(pd.Index(keys, tupleize_cols=False))
            for number, (shard, lang) in enumerate(groups):
                here = np.flatnonzero(group[text] == number)
                codes, own = pd.factorize(row[here])
                cuts = np.flatnonzero(np.diff(pieces[here])) + 1
                codes = np.insert(codes + 1, cuts, 0).astype(_code_type(len(own)))
                rows.append((shard, lang, codes.tobytes(), signed[own].tobytes(), None, None, len(here)))
            new = {n: w for n, w in zip(numbers, different, strict=True) if n not in sent}
            if new:
                if len(sent) > REMEMBERED_WORDS:
                    sent.clear()
                sent.update(new)
                own = np.array(list(new), dtype=np.uint64).view(np.int64)
                rows.append((DICTIONARY, None, None, None, own, list(new.values()), 0))
            kinds = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
                names=["shard", "lang", "codes", "numbers", "new", "words", "n"],
            )

    return encode


def _encoded(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored rows (shard, lang, codes, numbers, n) and the words (number, word); another seed if two words share a number."""
    for seed in range(8):
        schema = "shard int, lang string, codes binary, numbers binary, new array<bigint>, words array<binary>, n long"
        frame = map_arrow(texts, _encode(seed), schema)
        rows = stored(frame, "words", partition_by=["shard"])
        pairs = rows.filter(F.col("shard") == DICTIONARY).select(F.explode(F.arrays_zip("new", "words")).alias("pair"))
        words = stored(
            pairs.groupBy(F.col("pair.new").alias("number")).agg(
                F.min("pair.words").alias("word"), F.max("pair.words").alias("other")
            ),
            "dictionary",
        )
        if words.filter("word <> other").isEmpty():
            return rows.filter(F.col("shard") != DICTIONARY).drop("new", "words"), words.select(
                "number", F.col("word").cast("string").alias("word")
            )
    raise RuntimeError("different words share a number under every seed")


def _language_hash(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang))


def _phrases(lang: str, at: np.ndarray, numbers: np.ndarray, filters: Filters | None, longest: int):
    """By length, the different phrases of a row of words: (words, counts, keys, known, active).

    ``at`` has the place of each word in ``numbers``, and -1 between pieces. Of phrases longer
    than a word, only those whose two subphrases are ``known`` to the filters, and ``active`` if
    one of these is so lately.
    """
    words, counts = numbers[:, None], np.bincount(at[at >= 0], minlength=len(numbers))
    keys = mix(np.full(len(numbers), _language_hash(lang)), numbers.view(np.uint64))
    known, lately = filters.flags(keys) if filters else np.zeros((2, len(numbers)), dtype=bool)
    yield words, counts, keys, known, np.ones(len(words), dtype=bool)
    for length in range(2, longest + 1):
        ever = np.append(known, False)  # the last one for places where no phrase starts
        starts = np.flatnonzero(ever[at[:-1]] & ever[at[1:]])
        if not len(starts):
            return
        code, pairs = pd.factorize(at[starts].astype(np.int64) * len(known) + at[starts + 1])
        head, tail = np.divmod(pairs, len(known))
        words, counts = np.concatenate([words[head], words[tail, -1:]], axis=1), np.bincount(code)
        active = lately[head] | lately[tail]
        keys = mix(keys[head], words[:, -1].view(np.uint64))
        known, lately = filters.flags(keys)
        yield words, counts, keys, known, active
        longer = np.full(len(at), -1, dtype=np.int32)
        longer[starts] = code
        at = longer


def _joined(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows (codes, numbers) as one row of places in one array of different numbers, -1 between pieces and rows."""
    place, numbers = pd.factorize(np.concatenate([own for _, own in rows]))
    place = np.append(place, -1).astype(np.int32)
    parts, before = [], 0
    for codes, own in rows:
        parts += [place[np.where(codes > 0, codes + (before - 1), -1)], place[-1:]]
        before += len(own)
    return np.concatenate(parts), numbers


def _by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Words of rows (lang, codes, numbers), many rows of a language at once."""
    waiting: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    n_waiting = 0
    for batch in batches:
        for lang, *row in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            codes, numbers = (part.as_buffer() for part in row)
            numbers = np.frombuffer(numbers, dtype=np.int64)
            codes = np.frombuffer(codes, dtype=_code_type(len(numbers))).astype(np.int32)
            waiting.setdefault(lang, []).append((codes, numbers))
            n_waiting += len(codes)
            if n_waiting >= WORDS_AT_ONCE:
                while waiting:
                    lang, rows = waiting.popitem()
                    yield lang, *_joined(rows)
                n_waiting = 0
    while waiting:
        lang, rows = waiting.popitem()
        yield lang, *_joined(rows)


def _scan(marks, longest: int, singles: bool):
    """Rows of a shard to (length, key, n): its words, if wanted, and its active phrases."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = None if marks is None else Filters(marks.value)
        for lang, at, numbers in _by_language(batches):
            for words, counts, keys, _, active in _phrases(lang, at, numbers, filters, longest):
                length = words.shape[1]
                if (length > 1 or singles) and active.any():
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(pa.scalar(length, pa.int32()), int(active.sum())),
                            pa.array(keys[active].view(np.int64)),
                            pa.array(counts[active].astype(np.int64)),
                        ],
                        names=["length", "key", "n"],
                    )

    return scan


def _word_columns(longest: int) -> list[str]:
    return [f"word_{k}" for k in range(1, longest + 1)]


def _spell(marks, longest: int):
    """Rows of all shards to (lang, a column for each word, n) of the phrases that the filters know; nulls after the last word."""
    names = ["lang", *_word_columns(longest), "n"]

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = Filters(marks.value)
        for lang, at, numbers in _by_language(batches):
            for words, counts, _, known, _ in _phrases(lang, at, numbers, filters, longest):
                n, own = int(known.sum()), words[known]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(pa.scalar(lang, pa.string()), n),
                        *(pa.array(np.ascontiguousarray(own[:, k])) for k in range(own.shape[1])),
                        *(pa.nulls(n, pa.int64()) for _ in range(longest - own.shape[1])),
                        pa.array(counts[known].astype(np.int64)),
                    ],
                    names=names,
                )

    return spell


def _part(phrase: str, start: int | Column, size: int | Column) -> Column:
    return F.slice(phrase, start, size)


def phrase_counts(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    shards: int = SHARDS,
    text_column: str = "text",
    lang_column: str = "lang",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases (lang, phrase, n), words (number, word), and all word occurrences (lang, n).

    ``phrase`` is an array of word numbers. Every phrase of 1 to ``longest`` words with ``least``
    occurrences is there with its exact count. The corpus is dealt into ``shards``, which are
    scanned in turn, again and again. Words are counted from the first scan on; a longer phrase
    from the scan after the one in which the later of its two subphrases reached ``least``, be it
    in the middle of a cycle. Each is counted through one whole cycle, so that lengths overlap in
    time, and three lengths need between one and three cycles.

    The scans count 64-bit keys of phrases and find the active ones by filters of fixed size.
    Either may take one phrase for another, so that a rare one passes for frequent, but never a
    frequent one for rare. A last scan spells out what passed and counts it exactly.
    """
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANGUAGE))
    text = F.col(text_column).cast("string")
    shard = F.pmod(F.xxhash64(text), F.lit(shards)).cast("int")
    texts = docs.select(text.alias("text"), lang.alias("lang"), shard.alias("shard")).filter("text <> ''")
    rows, words = _encoded(texts)
    context = docs.sparkSession.sparkContext
    n_words = rows.groupBy("lang").agg(F.sum("n").alias("n"))
    in_shards = {r.shard: r.n for r in rows.groupBy("shard").agg(F.sum("n").alias("n")).collect()}

    def scanned(part: DataFrame, n: int) -> DataFrame:
        # Few words a task would send most phrases more often than there are different ones.
        return part.select("lang", "codes", "numbers").coalesce(max(1, n // WORDS_AT_ONCE))

    state: DataFrame | None = None
    step = 0
    while True:
        filters = None
        if state is not None:
            reached = state.filter(F.col("reached").isNotNull() & (F.col("length") < longest))
            filters = filters_of(reached.select("key", (F.col("reached") > step - shards).alias("recent")))
        if step >= shards and filters is None:
            break
        marks = None if filters is None else context.broadcast(filters.marks)
        here = scanned(rows.filter(F.col("shard") == step % shards), in_shards.get(step % shards, 0))
        counted = map_arrow(here, _scan(marks, longest, step < shards), "length int, key long, n long")
        counted = counted.select("*", F.lit(step).alias("first"), F.lit(None).cast("int").alias("reached"))
        merged = (counted if state is None else state.unionByName(counted)).groupBy("length", "key")
        merged = merged.agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("reached").alias("reached"))
        merged = merged.withColumn("reached", F.coalesce("reached", F.when(F.col("n") >= least, F.lit(step + 1))))
        # A cycle after a phrase was first met nothing of it can be missing.
        started = F.when(F.col("length") == 1, 0).otherwise(F.col("first"))
        before, state = state, stored(merged.filter(F.col("reached").isNotNull() | (started + shards > step + 1)), "state")
        if before is not None:
            discard(before)
        if marks is not None:
            marks.unpersist()
        step += 1
    passed = filters_of(state.filter(F.col("reached").isNotNull()).select("key", F.lit(True).alias("recent")))
    marks = context.broadcast(np.zeros((2, 1), dtype=np.uint64) if passed is None else passed.marks)
    every = scanned(rows, sum(in_shards.values()))
    # Words are columns until phrases are counted: numbers group faster than arrays.
    columns = _word_columns(longest)
    spelt = map_arrow(every, _spell(marks, longest), ", ".join(["lang string", *(f"{c} long" for c in columns), "n long"]))
    counts = spelt.groupBy("lang", *columns).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    counts = counts.select("lang", F.array_compact(F.array(*columns)).alias("phrase"), "n")
    return stored(counts, "frequent"), words, n_words


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int = TOP,
    shards: int = SHARDS,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """The strongest phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are what blanks and tabs separate inside pieces, A-Z in small letters. Candidates are
    phrases of 2 to ``longest`` words with at least ``least`` occurrences ``a``; ``l`` and ``r``
    are those of the two parts of its weakest cut (the first of equal ones), ``score`` is
    floor(1,000,000 a a / (l r)), exact. A candidate inside a longer one that has half of its
    occurrences or more is dropped. Ties in score go to the higher count, then to the phrase that
    is smaller in UTF-8. Null or empty texts have no words; rows without a language are ``und``;
    repeated rows count as often as they stand there; other columns are ignored. No words give
    no rows.
    """
    frequent, words, n_words = phrase_counts(docs, longest, least, shards, text_column, lang_column)
    size = F.size("phrase")
    candidates = frequent.filter(size > 1).withColumnRenamed("n", "a")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        _part("phrase", 1, F.col("k")).alias("head"),
        _part("phrase", F.col("k") + 1, size - F.col("k")).alias("tail"),
    )
    heads = frequent.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = frequent.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    # Products are decimals of 38 digits: counts may have 15.
    a, left, right = (f"CAST({c} AS DECIMAL(15, 0))" for c in "alr")
    score = F.expr(f"({a} * {a} * CAST(1000000 AS DECIMAL(7, 0))) div ({left} * {right})").cast("long")
    weakest = (
        cuts.join(heads, ["lang", "head"])
        .join(tails, ["lang", "tail"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    lengths = F.sequence(F.lit(2), size - 1)
    inner = F.flatten(
        F.transform(lengths, lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.slice("phrase", i, m)))
    )
    covering = (
        candidates.filter(size > 2)
        .select("lang", F.explode(inner).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    left_over = (
        weakest.join(covering, ["lang", "phrase"], "left")
        .filter(F.coalesce(100 * F.col("longer") < COVERED * F.col("a"), F.lit(True)))
        .drop("longer")
    )
    # Those that may be among the first without their words; ties at the end stay until they have them.
    order = [F.desc("score"), F.desc("a")]
    per_language = Window.partitionBy("lang").orderBy(*order)
    first = stored(left_over.withColumn("place", F.rank().over(per_language)).filter(F.col("place") <= top), "first")
    spelt = (
        first.select("lang", "phrase", F.posexplode("phrase").alias("at", "number"))
        .join(words, "number")
        .groupBy("lang", "phrase")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelt"))
        .select("lang", "phrase", F.array_join(F.col("spelt.word"), " ").alias("text"))
    )
    named = Window.partitionBy("lang").orderBy(*order, "text")
    return (
        first.join(spelt, ["lang", "phrase"])
        .withColumn("rank", F.row_number().over(named).cast("long"))
        .filter(F.col("rank") <= top)
        .join(n_words, "lang")
        .select("lang", "rank", F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
    )
