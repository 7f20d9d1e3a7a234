"""Registered queries of the corpus operators, and their SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.llm import cover_tree, exact_dedup, html_text, language_id, line_dedup, mixing, near_dedup, packing, phrases, quality, secret_scan, sharding, variants
from listenlake.llm.common import table
from listenlake.llm.oracles import ORACLES


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; other installations pass a path of their own."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.in_training_order(mixing.mixing_plan(table(spark, sf_dir, "documents")))
    first = F.get("positions", F.lit(0)).alias("first_position")
    return plan.select("doc_id", "size", "source_size", "target", "taken", first, "positions")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_report(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.learned_model(docs, tokenizer_file("piece_bpe_32k.model"))
    found = language_id.with_language(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        language_id.is_held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = cover_tree.whole_vectors(table(spark, sf_dir, "embeddings"))
    return cover_tree.top_products(vectors, "vec_id % 100 = 0")


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_texts(table(spark, sf_dir, "pages"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.with_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        quality.is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= quality.KEEP).cast("int").alias("predicted"),
    )


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_mixing,
        op2_near_dedup,
        op3_secrets,
        op4_line_dedup,
        op5_language,
        op6_exact_dedup,
        op7_top_products,
        op8_main_text,
        op9_packing,
        op10_sharding,
        op11_collocations,
        op12_quality,
        op13_variants,
        pipeline,
    )
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
