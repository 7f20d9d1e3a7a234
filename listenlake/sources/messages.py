"""Message folders: (topic, value) rows as Parquet, a stand-in for a broker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MESSAGE_SCHEMA = "topic STRING, value BINARY"


def as_messages(rows: DataFrame, topic: str) -> DataFrame:
    """Each row as a UTF-8 JSON message of ``topic``; NULL fields are left out."""
    return rows.select(
        F.lit(topic).alias("topic"), F.to_json(F.struct(*rows.columns)).cast("binary").alias("value")
    )


def stream_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MESSAGE_SCHEMA).parquet(path)
