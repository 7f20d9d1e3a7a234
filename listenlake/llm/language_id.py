"""Language identification by unigram pieces, summed over all segmentations of the text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import free_name, map_arrow, with_fields

# Labelled documents that the model is fitted on, about so many of each language: the ones
# with the least hash of the id, whatever the size of the corpus.
SAMPLE_PER_LANGUAGE = 300
EM_ROUNDS = 3
# Share of each piece's probability that comes from all languages together.
POOLED = 0.02
# Stretches without blanks are fitted in stretches of so many characters, and scored in those of the second length:
# no piece spans a cut, and words are not that long.
FIT_STRETCH, STRETCH = 32, 256
# Probability of a character that no piece of the vocabulary spells.
UNKNOWN = 1e-7
# Forward sums are multiplied by this for each character, so that a fitted stretch stays in range; in
# longer ones they are scaled anew after so many characters.
SCALE = 8.0
RESCALED = 16
WORD_START = "▁"
UNDETERMINED = "und"
# Words whose scores a Python worker remembers; it then starts anew.
REMEMBERED_WORDS = 200_000

def _powers(n: int, base: int) -> np.ndarray:
    factors = np.full(n + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.multiply.accumulate(factors)


_BASE = 0x9E3779B97F4A7C15
_POWER = _powers(STRETCH + 2, _BASE)
_INVERSE = _powers(STRETCH + 2, pow(_BASE, -1, 1 << 64))


def _prefixes(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first 0, 1, ... characters of words of at most ``width``, and the words' lengths."""
    letters = np.array(words, dtype=f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
    sums = np.zeros((width + 1, len(words)), dtype=np.uint64)
    np.cumsum(((letters + np.uint64(1)) * _POWER[:width]).T, axis=0, out=sums[1:])
    return sums, np.fromiter(map(len, words), dtype=np.int64, count=len(words))


class PieceTable:
    """Row of each piece of the vocabulary by the hash of its characters, looked up many at a time.

    Beginnings of pieces are entries too, so that a walk along a word can stop where no piece
    goes on: row -1 means that there is nothing, row 0 a beginning that is no piece itself.
    Hashes stand in a few arrays of slots: the second holds what found its slot of the first
    taken, and so on.
    """

    BITS = 17

    def __init__(self, pieces: list[str]) -> None:
        self.longest = max(map(len, pieces), default=1)
        entries = {piece[:i]: 0 for piece in pieces for i in range(1, len(piece))}
        entries.update((piece, row) for row, piece in enumerate(pieces, 1))
        hashes = np.zeros(len(entries), dtype=np.uint64)
        values = np.fromiter(entries.values(), dtype=np.int32, count=len(entries))
        for i, entry in enumerate(entries):
            hashes[i] = _prefixes([entry], len(entry))[0][-1, 0]
        left, self.levels = np.arange(len(entries)), []
        while len(left):
            slots = self._slots(hashes[left], len(self.levels))
            _, first = np.unique(slots, return_index=True)
            keys, rows = np.zeros(1 << self.BITS, dtype=np.uint64), np.full(1 << self.BITS, -1, dtype=np.int32)
            keys[slots[first]], rows[slots[first]] = hashes[left[first]], values[left[first]]
            self.levels.append((keys, rows))
            left = np.delete(left, first)

    def _slots(self, hashes: np.ndarray, level: int) -> np.ndarray:
        factor = np.uint64((0xD6E8FEB86659FD93 * (2 * level + 1)) & ((1 << 64) - 1))
        return ((hashes ^ (hashes >> np.uint64(29))) * factor >> np.uint64(64 - self.BITS)).astype(np.int64)

    def rows(self, hashes: np.ndarray, level: int = 0) -> np.ndarray:
        if level == len(self.levels):
            return np.full(len(hashes), -1, dtype=np.int32)
        keys, rows = self.levels[level]
        slots = self._slots(hashes, level)
        found = rows[slots]
        other = np.flatnonzero((keys[slots] != hashes) & (found >= 0))
        if len(other):
            found[other] = self.rows(hashes[other], level + 1)
        return found


def _forward(sums, lengths, table, probability, keep=False):
    """Scaled sums over all segmentations of every beginning of every word, by language; kept: the spans used.

    Words must be in order of length. From each place the sum so far is handed on along every
    piece that starts there, or along one unknown character if that is no piece. Unless spans are
    kept, sums are divided by their largest every ``RESCALED`` characters; the third result has
    the logarithms of what a word's sums were divided by.
    """
    n, width = sums.shape[1], len(sums) - 1
    alpha = np.zeros((width + 1, n, probability.shape[1]))
    alpha[0] = 1.0
    kept = []
    divided = np.zeros(n)
    for start in range(width):
        on = np.arange(np.searchsorted(lengths, start, side="right"), n)
        if not keep and start and start % RESCALED == 0:
            ahead = alpha[start : start + table.longest, on]
            largest = ahead.max(axis=(0, 2))
            largest[largest == 0] = 1.0
            alpha[start : start + table.longest, on] = ahead / largest[:, None]
            divided[on] += np.log(largest)
        for size in range(1, min(table.longest, width - start) + 1):
            on = on[lengths[on] >= start + size] if size > 1 else on
            rows = table.rows((sums[start + size, on] - sums[start, on]) * _INVERSE[start])
            hit = np.flatnonzero(rows > 0)
            words, row = on[hit], rows[hit]
            if keep:
                kept.append((start, start + size, words, row))
            alpha[start + size, words] += alpha[start, words] * (probability[row] * SCALE**size)
            if size == 1:
                miss = on[rows <= 0]
                alpha[start + 1, miss] += alpha[start, miss] * (UNKNOWN * SCALE)
            on = on[rows >= 0]
            if not len(on):
                break
    return alpha, kept, divided


def _by_width(words: list[str], cells: int = 200_000) -> Iterator[tuple[np.ndarray, list[str], int]]:
    """Words in groups of like length, with their places in ``words``."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        width = int(lengths[order[at]])
        most = max(1, cells // (width + 1))
        end = min(int(np.searchsorted(lengths[order], width + 1, side="right")), at + most)
        group = order[at:end]
        yield group, [words[i] for i in group], int(lengths[group[-1]])
        at = end


@dataclass
class LanguageModel:
    languages: list[str]
    table: PieceTable
    probability: np.ndarray  # piece row x language; row 0 is of no piece
    usual: np.ndarray  # log of the probability of a character, on average over what was learned of each language

    def stretch_scores(self, words: list[str]) -> np.ndarray:
        """Natural log of the probability in each language of each stretch, over all its segmentations."""
        out = np.zeros((len(words), len(self.languages)))
        for group, part, width in _by_width(words):
            sums, lengths = _prefixes(part, width)
            alpha, _, divided = _forward(sums, lengths, self.table, self.probability)
            ends = alpha[lengths, np.arange(len(part))]
            out[group] = np.log(np.maximum(ends, 1e-300)) + (divided - lengths * np.log(SCALE))[:, None]
        return out

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The same of whole words: the sum over a word's stretches."""
        if not words:
            return np.zeros((0, len(self.languages)))
        if max(map(len, words)) < STRETCH:
            return self.stretch_scores([WORD_START + w for w in words])
        cut = [stretches(w) for w in words]
        scores = self.stretch_scores([s for parts in cut for s in parts])
        starts = np.cumsum([0] + [len(parts) for parts in cut[:-1]])
        return np.add.reduceat(scores, starts, axis=0)


def stretches(word: str, size: int = STRETCH) -> list[str]:
    """A word opened by the vocabulary's mark of a word's start, in stretches of at most ``size`` characters."""
    marked = WORD_START + word
    return [marked[i : i + size] for i in range(0, len(marked), size)]


def fit_pieces(pieces: list[str], languages: list[str], counts: dict[str, np.ndarray], rounds: int = EM_ROUNDS):
    """Piece probabilities of each language from word counts by expectation maximisation.

    ``counts`` maps a stretch to its count in each language. Expected piece counts are taken
    over all segmentations (forward and backward sums), not the best one.
    """
    # Texts are read in small letters, so a piece with a capital stands nowhere in them.
    pieces = [p for p in dict.fromkeys(pieces) if 0 < len(p) <= FIT_STRETCH and p == p.lower()]
    table, n = PieceTable(pieces), len(languages)
    probability = np.full((len(pieces) + 1, n), 1.0 / max(1, len(pieces)))
    probability[0] = 0.0
    words = list(counts)
    weight = np.array([counts[w] for w in words], dtype=float).reshape(len(words), n)
    for _ in range(rounds):
        expected = np.zeros_like(probability)
        for group, part, width in _by_width(words):
            sums, lengths = _prefixes(part, width)
            alpha, kept, _ = _forward(sums, lengths, table, probability, keep=True)
            beta = np.zeros_like(alpha)
            beta[lengths, np.arange(len(part))] = 1.0
            total = np.maximum(alpha[lengths, np.arange(len(part))], 1e-300)
            share = weight[group] / total
            for start, end, hit, rows in sorted(kept, key=lambda s: -s[1]):
                back = probability[rows] * SCALE ** (end - start) * beta[end, hit]
                np.add.at(expected, rows, alpha[start, hit] * back * share[hit])
                beta[start, hit] += back
                if end - start == 1:
                    other = np.setdiff1d(np.flatnonzero(end <= lengths), hit, assume_unique=True)
                    beta[start, other] += UNKNOWN * SCALE * beta[end, other]
        pooled = expected.sum(axis=1, keepdims=True) + 1e-3
        pooled[0] = 0.0
        own = expected / np.maximum(expected.sum(axis=0), 1e-9)
        probability = (1 - POOLED) * own + POOLED * pooled / pooled.sum()
    model = LanguageModel(languages, table, probability, np.zeros(n))
    if words:
        characters = weight.T @ np.fromiter(map(len, words), float, len(words))
        model.usual = (weight * model.stretch_scores(words)).sum(axis=0) / np.maximum(characters, 1.0)
    return model


def _sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language: those whose hash lies below a bound set by its count."""
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    return labelled.join(F.broadcast(sizes), "lang").filter(place * F.col("n") < per_language)


def train(labelled: DataFrame, pieces: list[str], per_language: int = SAMPLE_PER_LANGUAGE) -> LanguageModel:
    """A model from a bounded sample of ``labelled`` (doc_id, text, lang); whole texts, null labels ignored.

    The driver holds the words of the sample: some ``per_language`` documents of each language.
    Without labelled rows no language is known.
    """
    rows = _sample(labelled.filter("lang IS NOT NULL AND text IS NOT NULL"), per_language)
    words = rows.select("lang", F.explode(F.split(F.lower("text"), r"(?U)\s+")).alias("word"))
    found = words.filter("word <> ''").groupBy("lang", "word").count().collect()
    languages = sorted({row.lang for row in found})
    column = {lang: i for i, lang in enumerate(languages)}
    counts: dict[str, np.ndarray] = {}
    for row in found:
        for stretch in stretches(row.word, FIT_STRETCH):
            if stretch not in counts:
                counts[stretch] = np.zeros(len(languages))
            counts[stretch][column[row.lang]] += row["count"]
    return fit_pieces(pieces, languages, counts)


class _WordScores:
    """Scores of the words a task has met; many texts are scored at a time."""

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1 << 16, len(model.languages)), dtype=np.float32)

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """Sum of the scores of each text's words."""
        if len(self.rows) > REMEMBERED_WORDS:
            self.rows.clear()
        new = list(set().union(*texts).difference(self.rows))
        at = len(self.rows)
        while at + len(new) > len(self.scores):
            self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
        self.scores[at : at + len(new)] = self.model.word_scores(new)
        self.rows.update(zip(new, range(at, at + len(new)), strict=True))
        sizes = np.array([len(words) for words in texts], dtype=np.int64)
        rows = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(texts)), np.int64, sizes.sum())
        totals = np.zeros((len(texts), len(self.model.languages)))
        some = np.flatnonzero(sizes)
        if len(some):
            starts = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            totals[some] = np.add.reduceat(self.scores[rows].astype(float), starts, axis=0)
        return totals


def _in_chunks(texts: pa.Array, flags: list[bool], words_at_once: int = 200_000) -> Iterator[list[list[str]]]:
    """The words of each text in turn, some texts at a time; none for texts without a letter."""
    chunk: list[list[str]] = []
    n = 0
    for i, flag in enumerate(flags):
        chunk.append(texts[i].as_py().lower().split() if flag else [])
        n += len(chunk[-1])
        if n >= words_at_once:
            yield chunk
            chunk, n = [], 0
    if chunk:
        yield chunk


def _predict(model: LanguageModel, text_index: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordScores(model)  # as long as the task lasts
        for batch in batches:
            langs, certain, fits = [], [], []
            flags = batch.column(batch.num_columns - 1).to_pylist()
            for chunk in _in_chunks(batch.column(text_index), [bool(f and model.languages) for f in flags]):
                for words, total in zip(chunk, known.totals(chunk), strict=True):
                    best = int(total.argmax()) if words else 0
                    langs.append(model.languages[best] if words else UNDETERMINED)
                    certain.append(float(1.0 / np.exp(total - total[best]).sum()) if words else 0.0)
                    characters = sum(map(len, words)) + len(words)
                    fits.append(float(total[best] / characters - model.usual[best]) if words else None)
            found = [pa.array(langs, pa.string()), pa.array(certain, pa.float64()), pa.array(fits, pa.float64())]
            names = [*batch.schema.names[:-1], "lang_pred", "lang_score", "lang_fit"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=names)

    return score


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def with_language(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``lang_fit`` after its own columns.

    A text's probability in a language is that of its words, each summed over all ways to cut it
    into pieces. The language with the highest one is predicted, with its share of the sum over
    all languages as score; ties go to the first in name order. The score only compares languages
    that were learned; ``lang_fit`` tells whether it is any of them: by how much the logarithm of
    a character's probability exceeds what is usual in that language (0: as usual, -2 and less:
    characters or words that the language hardly has). Null text and text without a
    letter give ``und`` with score 0 and no fit, as does a model without languages. Whole texts are read,
    one row at a time, so that any number of rows and copies is fine. Columns named like the
    new ones must be dropped before.
    """
    rows = docs.withColumn(free_name(docs, "has_letter"), has_letter(F.col(text_column)))
    schema = with_fields(docs, "lang_pred string, lang_score double, lang_fit double")
    return map_arrow(rows, _predict(model, docs.columns.index(text_column)), schema)


def is_held_out(doc_id: Column) -> Column:
    """The quarter of documents that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def vocabulary(model_path: str) -> list[str]:
    """The pieces of a public vocabulary file, spelt out; nothing else of it is used."""
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=model_path)
    return [pieces.id_to_piece(i) for i in range(pieces.get_piece_size()) if not pieces.is_control(i)]


def learned_model(docs: DataFrame, model_path: str) -> LanguageModel:
    """The model of ``docs`` (doc_id, text, lang): rows without id or label and held-out rows are not learned from."""
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    return train(labelled.filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))), vocabulary(model_path))
