"""Spelling variants: words one edit apart, found in a trie over letter-group counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_arrow, stored

LEAST_LENGTH = 5
LEAST_COUNT = 3
# A near word is a word's form if it is so many times as frequent.
FORM_FACTOR = 2
# One run in so many, by the hash of document and run, loses a letter.
NOISE = 97

# Levels of the trie: the letters of a group are those whose code points leave the same rest.
GROUPS = 8
# Words below a node that one task searches; the trie is cut at the first level where all have fewer.
NODE_WORDS = 20_000
# Different words a task of the first pass holds before it sends their counts.
WORDS_AT_ONCE = 300_000


# --- words ----------------------------------------------------------------------------


def _runs(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Runs of letters of UTF-8 texts: row of each in the list of different runs, that list, and its text's number.

    U+00C0 to U+00FF are the pairs of bytes that begin with C3.
    """
    blob = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    first = blob == 0xC3
    small = blob | 0x20
    inside = ((small >= 0x61) & (small <= 0x7A) & (blob < 0x80)) | first | np.concatenate([[False], first[:-1]])
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    stops = np.flatnonzero(inside & ~np.concatenate([inside[1:], [False]])) + 1
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    letters = np.where((blob >= 0x41) & (blob <= 0x5A), small, blob)[inside].tobytes()
    runs = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = runs.dictionary_encode()
    ends = np.cumsum([len(text) + 1 for text in texts])
    return (
        coded.indices.to_numpy(zero_copy_only=False),
        coded.dictionary.to_pylist(),
        np.searchsorted(ends, starts, side="right"),
    )


def _without_letter(run: bytes, h: int) -> bytes:
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _word_counts(noise: int):
    """Texts (id, text) to counts (word, n) of their runs after deletions; a word may come more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            names = pa.array(list(counts), pa.binary())
            numbers = pa.array(list(counts.values()), pa.int64())
            counts.clear()
            return pa.RecordBatch.from_arrays([names, numbers], names=["word", "n"])

        for batch in batches:
            row, runs, text = _runs(batch.column(1).cast(pa.binary()).to_pylist())
            if not len(row):
                continue
            heads = [crc32(f"{i}:".encode()) for i in batch.column(0).to_pylist()]
            pairs, times = np.unique(text * len(runs) + row, return_counts=True)
            text, row = np.divmod(pairs, len(runs))
            hashes = [crc32(runs[r], heads[t]) for t, r in zip(text.tolist(), row.tolist(), strict=True)]
            noisy = np.array(hashes) % noise == 0 if noise else np.zeros(len(row), dtype=bool)
            plain = np.bincount(row[~noisy], weights=times[~noisy], minlength=len(runs)).astype(np.int64).tolist()
            for run, n in zip(runs, plain, strict=True):
                if n:
                    counts[run] += n
            for i in np.flatnonzero(noisy).tolist():
                counts[_without_letter(runs[row[i]], hashes[i])] += int(times[i])
            if len(counts) >= WORDS_AT_ONCE:
                yield rows()
        if counts:
            yield rows()

    return count


def frequent_words(
    docs: DataFrame,
    least_count: int = LEAST_COUNT,
    least_length: int = LEAST_LENGTH,
    noise: int = NOISE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(word, n): the different words of all texts, those long and frequent enough."""
    texts = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).cast("string").alias("text")
    ).filter("text <> ''")
    counts = map_arrow(texts, _word_counts(noise), "word binary, n long")
    words = counts.select(F.col("word").cast("string").alias("word"), "n").filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


# --- trie -----------------------------------------------------------------------------


def group_counts(word: str) -> tuple[int, ...]:
    """How many letters of each group ``word`` has: its path from the root of the trie."""
    counts = [0] * GROUPS
    for letter in word:
        counts[ord(letter) % GROUPS] += 1
    return tuple(counts)


def _steps(count: int, surplus: int, deficit: int) -> tuple[tuple[int, int, int], ...]:
    """Counts that a partner may have where the word has ``count``, with what is left of the budgets.

    One inserted letter is a surplus of one, one replaced letter a surplus and a deficit, if it
    leaves its group. Of two words that differ by both, the one that lacks a letter first looks
    for the other, so that a pair is met once: the deficit is spent after the surplus only.
    """
    if surplus:
        return (count, surplus, deficit), (count + 1, 0, deficit)
    if deficit and count:
        return (count, 0, deficit), (count - 1, 0, 0)
    return ((count, surplus, deficit),)


def reachable(path: tuple[int, ...], depth: int) -> Iterator[tuple[int, ...]]:
    """Nodes at ``depth`` below which a word with this path may have partners, depth first."""
    open_ = [((), 1, 1)]
    while open_:
        node, surplus, deficit = open_.pop()
        if len(node) == depth:
            yield node
        else:
            open_ += [((*node, n), s, d) for n, s, d in _steps(path[len(node)], surplus, deficit)]


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


class Trie:
    """Words below one node, by the counts of the groups from ``depth`` on; leaves keep words by their halves.

    One edit leaves one half of a word as it is: a leaf's words with the same first or last half
    are verified, the others need not be looked at, however many there are.
    """

    def __init__(self, words: Iterable[str], depth: int) -> None:
        self.depth = depth
        self.root: dict = {}
        for word in words:
            node = self.root
            for count in group_counts(word)[depth:]:
                node = node.setdefault(count, {})
            half = len(word) // 2
            node.setdefault((len(word), True, word[:half]), []).append(word)
            node.setdefault((len(word), False, word[half:]), []).append(word)

    def partners(self, word: str, above: tuple[int, ...]) -> list[str]:
        """Words one edit from ``word`` that it must look for, below the node with the counts ``above``."""
        path = group_counts(word)
        surplus = deficit = 1
        for mine, theirs in zip(path, above, strict=False):
            surplus -= max(0, theirs - mine)
            deficit -= max(0, mine - theirs)
        found: list[str] = []
        open_ = [(self.root, self.depth, surplus, deficit)]
        while open_:
            node, level, surplus, deficit = open_.pop()
            if level == GROUPS:
                found += self._verified(node, word, path, len(word) + (not surplus and deficit))
                continue
            for count, s, d in _steps(path[level], surplus, deficit):
                below = node.get(count)
                if below is not None:
                    open_.append((below, level + 1, s, d))
        return found

    @staticmethod
    def _verified(leaf: dict, word: str, path: tuple[int, ...], length: int) -> list[str]:
        """Partners of ``length`` in a leaf; of two words with the same counts the smaller one looks."""
        half = length // 2
        near = leaf.get((length, True, word[:half]), []) + leaf.get((length, False, word[len(word) - (length - half) :]), [])
        if not near:
            return near
        same_path = length == len(word) and group_counts(near[0]) == path
        return [w for w in dict.fromkeys(near) if one_edit(word, w) and (not same_path or w > word)]


def _route(depth: int):
    """Words (word, n) to rows (node, asks, word, n): where each stands, and the nodes it has to search."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                path = group_counts(word)
                rows.append((path[:depth], False, word, n))
                rows += [(node, True, word, n) for node in reachable(path, depth)]
            if rows:
                node, asks, word, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.list_(pa.int32())), pa.array(asks), pa.array(word, pa.string()), pa.array(n, pa.int64())],
                    names=["node", "asks", "word", "n"],
                )

    return route


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by node, part and role to pairs of near words, each both ways: (word, near, near_n)."""
    here, node, trie = None, (), None
    words: dict[str, int] = {}
    for batch in batches:
        out: list[tuple[str, str, int]] = []
        columns = (batch.column(name).to_pylist() for name in ("node", "part", "asks", "word", "n"))
        for *at, asks, word, n in zip(*columns, strict=True):
            if at != here:
                here, trie, words = at, None, {}
            if not asks:
                words[word] = n
                continue
            if trie is None:
                node = tuple(here[0])
                trie = Trie(words, len(node))
            for near in trie.partners(word, node):
                out.append((word, near, words[near]))
                out.append((near, word, n))
        if out:
            word, near, n = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n, pa.int64())],
                names=["word", "near", "near_n"],
            )


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = Counter(map(group_counts, batch.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(paths), pa.list_(pa.int32())), pa.array(list(paths.values()), pa.int64())], names=["path", "n"]
        )


def _cut(words: DataFrame, node_words: int) -> tuple[int, DataFrame | None]:
    """The level at which the trie is cut, and (node, parts) of the leaves that are still too large."""
    paths = map_arrow(words.select("word"), _paths, "path array<int>, n long").groupBy("path").agg(F.sum("n").alias("n"))
    paths = stored(paths, "paths")
    nodes = paths.select(F.explode(F.sequence(F.lit(1), F.lit(GROUPS))).alias("depth"), "path", "n")
    nodes = nodes.groupBy("depth", F.slice("path", 1, F.col("depth")).alias("node")).agg(F.sum("n").alias("n"))
    largest = {r.depth: r.n for r in nodes.groupBy("depth").agg(F.max("n").alias("n")).collect()}
    depth = next((d for d in sorted(largest) if largest[d] <= node_words), GROUPS)
    if largest.get(depth, 0) <= node_words:
        return depth, None
    large = paths.filter(F.col("n") > node_words)
    return depth, large.select(F.col("path").alias("node"), F.ceil(F.col("n") / node_words).cast("int").alias("parts"))


def near_words(words: DataFrame, node_words: int = NODE_WORDS) -> DataFrame:
    """(word, near, near_n): every pair of ``words`` (word, n) one edit apart, both ways.

    Words hang in a trie by the counts of their letter groups, level by level. It is cut at the
    first level whose nodes all have at most ``node_words`` words; what hangs below a node is one
    group of rows, in which the words come first and then those that have to search it. A leaf
    that is still larger is dealt into parts, and those that search it go to each of them.
    """
    depth, large = _cut(words, node_words)
    routed = map_arrow(words.select("word", "n"), _route(depth), "node array<int>, asks boolean, word string, n long")
    if large is None:
        routed = routed.withColumn("part", F.lit(0))
    else:
        routed = routed.join(large, "node", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        own = F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
        every = F.sequence(F.lit(0), F.col("parts") - 1)
        routed = routed.withColumn("part", F.explode(F.when(F.col("asks"), every).otherwise(own))).drop("parts")
    grouped = routed.repartition("node", "part").sortWithinPartitions("node", "part", "asks")
    return map_arrow(grouped, _search, "word string, near string, near_n long")


def spelling_variants(
    docs: DataFrame,
    least_count: int = LEAST_COUNT,
    least_length: int = LEAST_LENGTH,
    form_factor: int = FORM_FACTOR,
    noise: int = NOISE,
    node_words: int = NODE_WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Each frequent word with its form: word, form, root, n, n_near, form_n.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF, A-Z in small letters; a run
    whose hash with the document's id is divisible by ``noise`` loses one letter first (0: none
    does). Two words are near if one letter is inserted, deleted or replaced. The form is the
    most frequent near word (of equal ones the smallest), if it has ``form_factor`` times the
    occurrences; the root is where the forms end. Null or empty texts have no words, a null id
    counts as no text before the colon, repeated rows count as often as they stand there, other
    columns are ignored; no words give no rows.
    """
    words = stored(frequent_words(docs, least_count, least_length, noise, id_column, text_column), "vocabulary")
    near = near_words(words, node_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus_n"), "near")).alias("best")
    )
    enough = -F.col("best.minus_n") >= form_factor * F.col("n")
    formed = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.minus_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(formed.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of each word's chain; chains double in length and end, as counts grow along them."""
    roots = forms
    while True:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = stored(roots.join(ahead, "root", "left"), "roots")
        if joined.filter("further IS NOT NULL").isEmpty():
            return joined.select("word", "root")
        roots = joined.select("word", F.coalesce("further", "root").alias("root"))
