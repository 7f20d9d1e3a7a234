"""Document quality by nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.common import map_arrow, stored, with_fields

# Labelled documents that are learned from, about so many of each label: those with the least
# hash of the id, whatever the size of the corpus.
SAMPLE_PER_LABEL = 1_000
# Terms are hashed to so many columns of each kind, and a text's columns of one kind together
# weigh so much, however many they are.
WORDS, SHAPES, FORMS = range(3)
COLUMNS = (3072, 1008, 16)
WEIGHTS = (0.8, 1.0, 0.6)
FIRST = np.concatenate([[0], np.cumsum(COLUMNS)])
N_TERMS = int(FIRST[-1])
RANK = 64
POWER_ROUNDS = 4
NEIGHBOURS = 15
# Votes fall with the distance: the similarity counts to this power.
SHARPNESS = 8
KEEP = 0.7
# Texts whose products with all labelled vectors are held at once.
BLOCK = 512
_BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


# --- terms ----------------------------------------------------------------------------


def _shape(word: bytes) -> bytes:
    """What a word looks like: A, a, 0 for runs of capitals, small letters and digits, other signs once a run."""
    out = bytearray()
    for c in word.decode("utf-8", "replace"):
        kind = ord("A") if c.isupper() else ord("a") if c.isalpha() else ord("0") if c.isdigit() else min(ord(c), 255)
        if not out or out[-1] != kind:
            out.append(kind)
    return bytes(out)


def _column(kind: int, term: bytes) -> int:
    return int(FIRST[kind] + xxhash.xxh64_intdigest(term, kind) % COLUMNS[kind])


def _buckets(values: np.ndarray, first: int) -> np.ndarray:
    """0, 1, ... 7 by powers of four, as columns from ``first`` on."""
    return FIRST[FORMS] + first + np.minimum(7, np.ceil(np.log2(values + 1.0) / 2)).astype(np.int64)


def text_terms(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, column, count) of the terms of UTF-8 texts, sorted by text and column.

    Terms are words in small letters, shapes of words, and by how many words a text has and how
    many of a hundred of them stand right after themselves (both by powers of four). An empty
    text has the latter only.
    """
    blob = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    blank = _BLANKS[blob]
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    stops = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(blob[~blank].tobytes())])
    coded = words.dictionary_encode()
    row = coded.indices.to_numpy(zero_copy_only=False)
    different = coded.dictionary.to_pylist()
    text = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    columns = np.array(
        [[_column(WORDS, w.lower()), _column(SHAPES, _shape(w))] for w in different], dtype=np.int64
    ).reshape(-1, 2)
    lengths = np.bincount(text, minlength=len(texts))
    again = np.concatenate([[False], (row[1:] == row[:-1]) & (text[1:] == text[:-1])]) if len(row) else row.astype(bool)
    repeats = 100 * np.bincount(text[again], minlength=len(texts)) / np.maximum(lengths, 1)
    every = np.arange(len(texts))
    keys = np.concatenate([text, text, every, every]) * N_TERMS + np.concatenate(
        [columns[row, 0], columns[row, 1], _buckets(lengths, 0), _buckets(repeats, 8)]
    )
    pairs, counts = np.unique(keys, return_counts=True)
    return pairs // N_TERMS, pairs % N_TERMS, counts


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (column, n): in how many of a task's texts a term stands; column -1 counts the texts."""
    counts = np.zeros(N_TERMS + 1, dtype=np.int64)
    for batch in batches:
        _, column, _ = text_terms(_bytes(batch.column(0)))
        counts[:-1] += np.bincount(column, minlength=N_TERMS)
        counts[-1] += batch.num_rows
    some = np.flatnonzero(counts)
    names = np.where(some == N_TERMS, -1, some)
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(counts[some])], names=["column", "n"])


def _bytes(texts: pa.Array) -> list[bytes]:
    return [text or b"" for text in texts.cast(pa.binary()).to_pylist()]


def _sample_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, quality, text) to (doc_id, quality, columns, counts)."""
    for batch in batches:
        text, column, count = text_terms(_bytes(batch.column(2)))
        ends = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(column)),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(count)),
            ],
            names=["doc_id", "quality", "columns", "counts"],
        )


# --- model ----------------------------------------------------------------------------


def _weighted(text: np.ndarray, column: np.ndarray, count: np.ndarray, rarity: np.ndarray, n: int) -> np.ndarray:
    """Weights of terms: 1 + ln(count), times rarity, each kind of a text scaled to its share."""
    weight = ((1.0 + np.log(count)) * rarity[column]).astype(np.float32)
    kind = np.searchsorted(FIRST, column, side="right") - 1
    norm = np.sqrt(np.bincount(text * len(COLUMNS) + kind, weights=weight**2, minlength=n * len(COLUMNS)))
    scale = np.asarray(WEIGHTS)[kind] / np.maximum(norm[text * len(COLUMNS) + kind], 1e-12)
    return (weight * scale).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class NeighbourModel:
    """Labelled latent vectors (unit rows), their labels, and the way from terms to latent vectors.

    At most about 2 x ``SAMPLE_PER_LABEL`` x ``RANK`` + ``N_TERMS`` x ``RANK`` single-precision
    numbers (1.6 MB), whatever the corpus.
    """

    vectors: np.ndarray
    labels: np.ndarray
    projection: np.ndarray  # term x rank
    rarity: np.ndarray
    shares: np.ndarray  # of labels 0 and 1 among the rows that may be learned from

    def latent(self, texts: list[bytes]) -> np.ndarray:
        text, column, count = text_terms(texts)
        weight = _weighted(text, column, count, self.rarity, len(texts))
        starts = np.searchsorted(text, np.arange(len(texts)))  # every text has a term
        return _unit(np.add.reduceat(self.projection[column] * weight[:, None], starts, axis=0))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """The weighted share of label 1 among the nearest labelled vectors of each text, by cosine."""
        if not len(self.labels):
            return np.full(len(texts), 0.5)
        out = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        # Each label has the say in all that it has among the documents, however many stand for it.
        say = (self.shares / np.maximum(np.bincount(self.labels, minlength=2), 1))[self.labels]
        for at in range(0, len(texts), BLOCK):
            vectors = self.latent(texts[at : at + BLOCK])
            cosines = np.round(vectors @ self.vectors.T, 5)
            # Of equal cosines the labelled vectors that come first count.
            worst = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
            above = cosines > worst
            ties = (cosines == worst) & (np.cumsum(cosines == worst, axis=1) <= k - above.sum(axis=1, keepdims=True))
            votes = np.where(above | ties, np.maximum(cosines, 0.0) ** SHARPNESS * say, 0.0)
            total = votes.sum(axis=1)
            for_one = votes[:, self.labels == 1].sum(axis=1)
            out[at : at + BLOCK] = np.where(total > 0, for_one / np.where(total > 0, total, 1.0), 0.5)
        return out


def fit(
    labels: np.ndarray,
    columns: list[list[int]],
    counts: list[list[int]],
    document_counts: np.ndarray,
    n_documents: int,
    shares: np.ndarray,
) -> NeighbourModel:
    """The model of labelled texts, given by their terms: a truncated SVD of their term weights."""
    rarity = np.log((1.0 + n_documents) / (1.0 + document_counts)) + 1.0
    rarity[FIRST[FORMS] :] = 1.0
    n = len(labels)
    if not n:
        nothing = np.zeros((0, RANK), np.float32)
        return NeighbourModel(nothing, np.zeros(0, np.int64), np.zeros((N_TERMS, RANK), np.float32), rarity, shares)
    text = np.repeat(np.arange(n), [len(c) for c in columns])
    column, count = np.concatenate(columns).astype(np.int64), np.concatenate(counts)
    matrix = np.zeros((n, N_TERMS), dtype=np.float32)
    matrix[text, column] = _weighted(text, column, count, rarity, n)
    # Subspace iteration from a fixed start finds the strongest directions.
    basis = np.random.default_rng(7).standard_normal((N_TERMS, RANK + 16)).astype(np.float32)
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, strength, turns = np.linalg.svd(matrix @ basis, full_matrices=False)
    kept = min(RANK, int((strength > 1e-6).sum()))
    projection = (basis @ turns[:kept].T).astype(np.float32)
    return NeighbourModel(_unit(matrix @ projection), np.asarray(labels, dtype=np.int64), projection, rarity, shares)


def _sample(labelled: DataFrame, sizes: DataFrame, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label: those whose hash lies below a bound set by its count."""
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    return labelled.join(F.broadcast(sizes), "quality").filter(place * F.col("n") < per_label).drop("n")


def is_held_out(doc_id: Column) -> Column:
    """The quarter of documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> NeighbourModel:
    """The model of ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    How rare terms are is counted over all documents; labels come from a bounded sample of the
    rows that are not held out. Labels other than 0 and 1 and rows without an id are ignored; an
    id labelled both ways teaches both. The driver gets the document counts of ``N_TERMS`` terms
    and the term counts of some 2 x ``per_label`` texts, at most ``N_TERMS`` each.
    """
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counted = map_arrow(texts.select("text"), _document_counts, "column long, n long")
    counts = {r["column"]: r.n for r in counted.groupBy("column").agg(F.sum("n").alias("n")).collect()}
    document_counts = np.array([counts.get(c, 0) for c in range(N_TERMS)], dtype=float)
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter("quality IN (0, 1)")
    usable = usable.filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).distinct()
    sizes = stored(usable.groupBy("quality").agg(F.count("*").alias("n")), "label-sizes")
    n_labelled = {r.quality: r.n for r in sizes.collect()}
    shares = np.array([n_labelled.get(q, 0) for q in (0, 1)]) / max(1, sum(n_labelled.values()))
    chosen = stored(_sample(usable, sizes, per_label), "labels")
    learned = chosen.join(texts, "doc_id").select("doc_id", "quality", "text")
    rows = map_arrow(learned, _sample_terms, "doc_id long, quality int, columns array<long>, counts array<long>").collect()
    # Repeated ids teach once per different text.
    rows = sorted({(r.doc_id, r.quality, tuple(r.columns), tuple(r.counts)) for r in rows})
    return fit(np.array([r[1] for r in rows]), [r[2] for r in rows], [r[3] for r in rows], document_counts, counts.get(-1, 0), shares)


def with_quality(docs: DataFrame, model: NeighbourModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``quality_score`` after its own columns, from the whole text alone.

    The score is the share of label 1 in the votes of the ``NEIGHBOURS`` labelled texts that are
    nearest by cosine, each weighing its similarity to a power; a label weighs in all what its
    share of the labelled rows is. A text that resembles none, or a model without labels, gives 0.5. Null counts as empty; empty texts
    are near other short ones. Rows are scored one by one: repeated rows get equal scores. A
    column named like the new one must be dropped before.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    index = docs.columns.index(text_column)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(_bytes(batch.column(index)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "quality_score"]
            )

    return map_arrow(docs, score, with_fields(docs, "quality_score double"))
