"""Kafka topics as (topic, value) frames."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


def kafka_options(brokers: str, topics: Iterable[str], **overrides: str) -> dict[str, str]:
    """Source options: subscribe to the topics, from the earliest offset on.

    Messages that expired before they were read stop the query, unless an override allows the loss.
    """
    wanted = list(topics)
    if not wanted:
        raise ValueError("no topic to subscribe to")
    return {
        "kafka.bootstrap.servers": brokers,
        "subscribe": ",".join(wanted),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        **overrides,
    }


def stream_topics(spark: SparkSession, brokers: str, topics: Iterable[str], **overrides: str) -> DataFrame:
    """Endless frame of the topics' messages (needs the Kafka package, see ``session``)."""
    return spark.readStream.format("kafka").options(**kafka_options(brokers, topics, **overrides)).load()


def read_topics(spark: SparkSession, brokers: str, topics: Iterable[str], **overrides: str) -> DataFrame:
    """The same messages up to now as a batch frame, for backfills."""
    return spark.read.format("kafka").options(**kafka_options(brokers, topics, **overrides)).load()
