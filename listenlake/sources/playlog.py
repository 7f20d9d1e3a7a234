"""Topic rows derived from the commerce tables of a test-data folder.

``events`` rows become plays and visits: the part they mention is the song, the
customer is the listener, the customer's nation is the place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.functions.times import epoch_millis
from listenlake.operators.ordering import number_within
from listenlake.schemas import TOPIC_SCHEMAS

# Agent text by event_id % 6; 5 has none.
AGENTS = [
    "Mozilla/5.0 (Windows NT 6.1) Chrome/36.0 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1 like Mac OS X) Mobile Safari/9537",
    "Mozilla/5.0 (X11; Linux x86_64) Firefox/31.0",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9) Safari/537",
    "curl/7.1",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .withColumns({"k": F.get_json_object("props", "$.k").cast("int"), "ms": epoch_millis("ts"), "day": F.dayofmonth("ts")})
        .drop("props", "ts")
    )


def _with_part_and_listener(events: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name")
    listeners = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "c_name", "c_nationkey", "n_name", "r_name")
    )
    return (
        events.join(parts, F.col("k") == F.col("p_partkey"), "left")
        .drop("k", "p_partkey")
        .join(listeners, F.col("user_id") == F.col("c_custkey"), "left")
        .drop("c_custkey")
    )


def numbered_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with the columns of all topics.

    ``itemInSession`` is counted per user and day by time, then event, before the columns that
    follow from others are there: rows are narrow where they move, and windows by user and day
    take them as the join by user dealt them.
    """
    events = _events(spark, sf_dir)
    found = _with_part_and_listener(events, spark, sf_dir)
    numbered = number_within(found, ["user_id", "day"], ["ms", "event_id"], "itemInSession", sized_like=events)
    played = F.col("event_type") != "error"
    agent = F.lit(None).cast("string")
    for number, text in enumerate(AGENTS):
        agent = F.when(F.col("event_id") % 6 == number, text).otherwise(agent)
    return numbered.select(
        "event_id",
        "event_type",
        "day",
        F.when(played, F.col("p_brand")).alias("artist"),
        F.when(played, F.col("p_name")).alias("song"),
        # Five decimals, as the service sends them.
        (F.col("value") + F.col("event_id") % 100 / 100_000).alias("duration"),
        F.col("ms").alias("ts"),
        (F.col("user_id") * 100 + F.col("day")).cast("int").alias("sessionId"),
        F.lit("Logged In").alias("auth"),
        F.when(F.col("value") >= 20, "paid").otherwise("free").alias("level"),
        F.col("n_name").alias("city"),
        F.col("user_id").cast("string").alias("zip"),
        F.col("r_name").alias("state"),
        agent.alias("userAgent"),
        (100.0 - F.col("c_nationkey") * 2.0).alias("lon"),
        (F.col("c_nationkey") * 1.5).alias("lat"),
        F.col("user_id").alias("userId"),
        F.concat(F.lit("L"), (F.col("user_id") % 7).cast("string")).alias("lastName"),
        F.col("c_name").alias("firstName"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        (F.col("user_id") * 86_400_000 + 1_609_459_200_000).alias("registration"),
        F.col("event_type").alias("page"),
        F.when(F.col("event_type") == "view", "GET").otherwise("PUT").alias("method"),
        F.when(played, 200).otherwise(404).alias("status"),
        played.alias("success"),
        "itemInSession",
    )


def topic_events(visits: DataFrame, topic: str) -> DataFrame:
    """The columns of one topic, typed by its schema, after ``event_id``."""
    fields = TOPIC_SCHEMAS[topic].fields
    return visits.select("event_id", *[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
