"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written and read again
as the next one's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm import exact_dedup, language_id, mixing, near_dedup, packing
from listenlake.llm.common import stored, table
from listenlake.llm.queries import tokenizer_file

# A document is rejected if the logarithm of a character's probability in its best language is so much
# below what is usual there: texts in other scripts lie 6.5 to 19 below, learned ones within 1, and within 5 if most of
# a short one is numbers.
LEAST_FIT = -6.0


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or that no language claims, go; the others get the language they are in."""
    model = language_id.learned_model(docs, tokenizer_file("piece_bpe_32k.model"))
    found = language_id.with_language(docs, model)
    claimed = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("lang_fit") >= LEAST_FIT)
    return found.filter(claimed).withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, left out or repeated as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language models and token ids are beyond SQL; the tests hold the run against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
