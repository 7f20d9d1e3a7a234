"""Spark session set-up."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. Executor sizes, the master and object-store
# credentials (fs.gs.*, fs.s3a.*) belong to spark-submit or spark-defaults.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def kafka_package(spark_version: str, scala_version: str = "2.13") -> str:
    """Maven coordinate of the Kafka source that fits the running Spark."""
    return f"org.apache.spark:spark-sql-kafka-0-10_{scala_version}:{spark_version}"


def build_session(
    app_name: str = "listenlake",
    master: str | None = None,
    with_kafka: bool = False,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or get) a session; ``settings`` win over the defaults above."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if with_kafka:
        import pyspark

        builder = builder.config("spark.jars.packages", kafka_package(pyspark.__version__))
    for key, value in {**SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
