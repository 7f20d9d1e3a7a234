"""Small result tables over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_songs(facts: DataFrame, songs: DataFrame, k: int) -> DataFrame:
    """The ``k`` most played songs (ties by id) in order, with their rank and names.

    The counts are ranked and joined to the names after the cut, when ``k`` rows are left.
    """
    order = [F.desc("plays"), F.asc("song_id")]
    leaders = (
        facts.filter(F.col("song_id").isNotNull())
        .groupBy("song_id")
        .agg(F.sum("plays_count").alias("plays"))
        .orderBy(*order)
        .limit(k)
        .withColumn("rank", F.row_number().over(Window.orderBy(*order)))
    )
    named = songs.join(leaders, "song_id").select("rank", "song_id", "song_name", "song_duration", "plays")
    return named.orderBy("rank")


def active_users(facts: DataFrame, user: str) -> DataFrame:
    """Distinct users per calendar key (hour or day, as the facts are)."""
    return facts.groupBy("datetime_id").agg(
        F.countDistinct(user).alias("active_users"), F.sum("plays_count").alias("plays")
    )


def demographics(users: DataFrame) -> DataFrame:
    return users.groupBy("gender", "level").agg(F.count("*").alias("users"))
