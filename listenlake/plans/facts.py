"""Fact tables: one row per play, with the surrogate keys of its dimensions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.functions.times import utc_date, utc_hour
from listenlake.operators.lookup import attach_key


# What facts need of a play.
PLAY_COLUMNS = [
    "artist", "song", "duration", "ts", "sessionId", "level", "city", "zip", "state", "userAgent", "lon", "lat", "userId"
]


@dataclass(frozen=True)
class Star:
    """The dimensions a fact table points to."""

    song: DataFrame
    artist: DataFrame
    city: DataFrame
    calendar: DataFrame
    user: DataFrame
    session: DataFrame
    device: DataFrame | None = None


def _attach_dimensions(plays: DataFrame, star: Star, calendar_on: dict[str, str]) -> DataFrame:
    """All lookups; each drops nothing, so rows and measures are those of the plays.

    The lookups that Spark can broadcast come first and cost no shuffle; those
    that grow with the traffic (artist place, user, session) come last, when the
    rows are narrow, because the columns of earlier keys are pruned by then.
    """
    rows = attach_key(plays, star.calendar, calendar_on, "DateSK", "datetime_id")
    if star.device is not None:
        # No agent is a device of its own, so the match is on a text that is never NULL.
        agent = F.coalesce(F.concat(F.lit("="), "userAgent"), F.lit(""))
        devices = star.device.withColumn("agent", agent)
        rows = attach_key(rows.withColumn("agent", agent), devices, {"agent": "agent"}, "device_id")
    rows = attach_key(
        rows,
        star.city,
        {"city": "city_name", "state": "state", "zip": "zip_code", "lat": "latitude", "lon": "longitude"},
        "city_id",
    )
    rows = attach_key(rows, star.song, {"song": "song_name", "duration": "song_duration"}, "song_id")
    rows = attach_key(
        rows,
        star.artist.filter("is_active"),
        {"artist": "artist_name", "lat": "latitude", "lon": "longitude"},
        "artist_id",
    )
    users = star.user.select("userId", F.struct("userKey", F.col("userId").alias("user_id_fk")).alias("user"))
    rows = attach_key(rows, users, {"userId": "userId"}, "user")
    sessions = star.session.filter("is_active")
    return attach_key(rows, sessions, {"sessionId": "sessionId"}, "session_id", "session_id_fk")


def fact_by_day(plays: DataFrame, star: Star) -> DataFrame:
    """Fact rows that point to the day calendar."""
    rows = _attach_dimensions(
        plays.withColumn("event_date", utc_date(F.col("ts"))), star, {"event_date": "Date"}
    )
    return rows.select(
        F.col("user.userKey").alias("userKey"),
        "song_id",
        "artist_id",
        "city_id",
        "datetime_id",
        "session_id_fk",
        *(["device_id"] if star.device is not None else []),
        "level",
        "ts",
        F.lit(1).alias("plays_count"),
    )


def fact_by_hour(plays: DataFrame, star: Star) -> DataFrame:
    """Fact rows that point to the hour calendar and keep the duration."""
    rows = _attach_dimensions(
        plays.withColumns({"event_date": utc_date(F.col("ts")), "event_hour": utc_hour(F.col("ts"))}),
        Star(
            **{
                **star.__dict__,
                "calendar": star.calendar.select(F.col("date").cast("date").alias("Date"), "Hour", "DateSK"),
            }
        ),
        {"event_date": "Date", "event_hour": "Hour"},
    )
    return rows.select(
        F.col("user.user_id_fk").alias("user_id_fk"),
        "song_id",
        "artist_id",
        "city_id",
        "datetime_id",
        "session_id_fk",
        *(["device_id"] if star.device is not None else []),
        "level",
        "ts",
        "duration",
        F.lit(1).alias("plays_count"),
    )
