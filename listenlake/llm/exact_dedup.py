"""Exact de-duplication: a two-pass Bloom filter lets unique rows pass without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import SPACE, stored

# Only runs that differ from one plain blank need to be replaced.
UNEVEN_SPACE = rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+"

# Filter words of 64 bits per row: a word is shared by another row in a fifth of the cases,
# and their three bits then overlap in about an eighth of these.
WORDS_PER_ROW = 4
# Repeated words up to this many (some 60 MB as a hash table) are broadcast; more are joined by shuffle.
BROADCAST_WORDS = 1_000_000


def normalised(text: Column) -> Column:
    """Null as empty; every run of white space as one blank."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), UNEVEN_SPACE, " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def _bits(seed: int) -> Column:
    """Three of the 64 bits of a filter word, chosen by a second hash."""
    h = F.xxhash64("text_sha256", F.lit(seed))
    places = [F.shiftright(h, shift).bitwiseAND(F.lit(63)).cast("int") for shift in (0, 6, 12)]
    marks = [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]
    return marks[0].bitwiseOR(marks[1]).bitwiseOR(marks[2])


def _with_word(rows: DataFrame, n_words: int) -> DataFrame:
    return rows.withColumn("_word", F.pmod(F.xxhash64("text_sha256"), F.lit(n_words)))


def _repeated_words(digests: DataFrame, words_per_row: int, broadcast_words: int) -> tuple[DataFrame, int]:
    """First pass: the filter words in which some bit was set twice, and the size of the filter."""
    n_words = max(1, digests.count() * words_per_row)
    filled = (
        _with_word(digests.select("text_sha256"), n_words)
        .select("_word", _bits(17).alias("bits"))
        .groupBy("_word")
        .agg(F.bit_or("bits").alias("seen"), F.sum(F.bit_count("bits")).alias("marks"))
    )
    repeated = stored(filled.filter(F.col("marks") > F.bit_count("seen")).select("_word"), "repeated-words")
    if repeated.count() <= broadcast_words:
        repeated = F.broadcast(repeated)
    return repeated, n_words


def _digests(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    hashed = docs.select(F.col(id_column).alias("doc_id"), text_digest(F.col(text_column)).alias("text_sha256"))
    return stored(hashed, "digests")


def exact_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    words_per_row: int = WORDS_PER_ROW,
    broadcast_words: int = BROADCAST_WORDS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised SHA-256 is. The first pass sets three bits per row in
    a Bloom filter of 64-bit words, spread over the cluster; a word in which some bit was set
    twice may hold a repeated text. The second pass looks every row up: rows of clean words are
    certainly unique and pass straight through; only the others shuffle and are grouped by
    digest. Filter errors cost a shuffled row, never a wrong result. Repeated words are broadcast
    only if counted to be at most ``broadcast_words``; else the look-up is a plain join.

    Null text counts as empty. Rows without an id group like others, and keep_id is the smallest
    id that is not null (null if there is none). Rows equal in id and text are all ``kept`` if
    one is; ``drop_exact_duplicates`` keeps one of them. Other columns are ignored.
    """
    digests = _digests(docs, id_column, text_column)
    repeated, n_words = _repeated_words(digests, words_per_row, broadcast_words)
    rows = _with_word(digests, n_words)
    unique = rows.join(repeated, "_word", "left_anti").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    suspects = rows.join(repeated, "_word", "left_semi")
    groups = suspects.groupBy("text_sha256").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    grouped = suspects.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
    return unique.unionByName(grouped)


def drop_exact_duplicates(
    docs: DataFrame, words_per_row: int = WORDS_PER_ROW, broadcast_words: int = BROADCAST_WORDS
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, that of the smallest id, whole and unchanged.

    Here too only rows of repeated filter words shuffle with their texts. A group all of whose
    ids are null keeps one row. ``docs`` must have ``doc_id`` and ``text``; names that begin with
    ``_exact`` are reserved.
    """
    digests = _digests(docs, "doc_id", "text")
    repeated, n_words = _repeated_words(digests, words_per_row, broadcast_words)
    repeated = repeated.select(F.col("_word").alias("_exact_word"))
    marked = docs.withColumn("_exact_sha", text_digest(F.col("text"))).withColumn(
        "_exact_word", F.pmod(F.xxhash64("_exact_sha"), F.lit(n_words))
    )
    unique = marked.join(repeated, "_exact_word", "left_anti")
    suspects = marked.join(repeated, "_exact_word", "left_semi")
    keepers = (
        _with_word(digests, n_words)
        .withColumnRenamed("_word", "_exact_word")
        .join(repeated, "_exact_word", "left_semi")
        .groupBy(F.col("text_sha256").alias("_exact_sha"))
        .agg(F.min("doc_id").alias("_exact_keep"))
    )
    # The smallest id of a text may stand in several rows: one of them is taken.
    first = suspects.join(keepers, "_exact_sha").filter(F.col("doc_id").eqNullSafe(F.col("_exact_keep")))
    first = first.dropDuplicates(["_exact_sha"])
    return unique.unionByName(first.select(*unique.columns)).select(*docs.columns)
