"""Song, artist, city, device and session dimensions from the plays."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.functions.agents import device_columns
from listenlake.functions.nulls import all_known
from listenlake.functions.times import utc_second
from listenlake.operators.ordering import dense_keys, highest_key
from listenlake.operators.scd2 import (
    VersionChanges,
    append_members,
    as_first_version,
    merge_versions,
    version_changes,
)
from listenlake.schemas import require_columns

SONG_KEY = ["song_name", "song_duration"]
ARTIST_KEY = ["artist_name", "latitude", "longitude"]
CITY_KEY = ["city_name", "state", "zip_code", "latitude", "longitude"]
SESSION_ORDER = ["StartTime", "sessionId"]


def song_members(plays: DataFrame) -> DataFrame:
    return (
        plays.select(F.col("song").alias("song_name"), F.col("duration").alias("song_duration"))
        .filter(all_known(SONG_KEY))
        .dropDuplicates()
    )


def _first_or_grown(members: DataFrame, existing: DataFrame | None, natural: list[str], key: str) -> DataFrame:
    """Number all members, or keep the keys of ``existing`` and number the new ones after them."""
    if existing is None:
        return dense_keys(members, natural, key)
    return append_members(existing, members, natural, key)


def song_dimension(plays: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _first_or_grown(song_members(plays), existing, SONG_KEY, "song_id")


def artist_members(plays: DataFrame) -> DataFrame:
    """Artists by the place they were heard in: the place is part of the key."""
    return (
        plays.select(
            F.col("artist").alias("artist_name"),
            F.col("lat").alias("latitude"),
            F.col("lon").alias("longitude"),
        )
        .filter(all_known(ARTIST_KEY))
        .dropDuplicates()
    )


def artist_dimension(plays: DataFrame, effective: date, existing: DataFrame | None = None) -> DataFrame:
    """First build, or ``existing`` plus the artist places it does not know yet."""
    members = as_first_version(artist_members(plays), effective)
    return _first_or_grown(members, existing, ARTIST_KEY, "artist_id")


def city_members(plays: DataFrame) -> DataFrame:
    """Listener places; any part may be NULL."""
    return plays.select(
        F.col("city").alias("city_name"),
        F.col("state"),
        F.col("zip").alias("zip_code"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
    ).dropDuplicates()


def city_dimension(plays: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return _first_or_grown(city_members(plays), existing, CITY_KEY, "city_id")


def device_members(plays: DataFrame) -> DataFrame:
    """Agent texts, a missing one included; parsed after the distinct."""
    agents = plays.select("userAgent").distinct()
    return agents.withColumns(device_columns(F.col("userAgent")))


def device_dimension(plays: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """One row per agent text."""
    return _first_or_grown(device_members(plays), existing, ["userAgent"], "device_id").select(
        "device_id", "userAgent", "device_type", "operating_system", "browser"
    )


def session_bounds(plays: DataFrame) -> DataFrame:
    return (
        require_columns(plays, ["sessionId", "ts"])
        .groupBy("sessionId")
        .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
        .select(
            "sessionId",
            utc_second(F.col("first_ts")).alias("StartTime"),
            utc_second(F.col("last_ts")).alias("EndTime"),
        )
    )


def _widened(bounds: DataFrame, existing: DataFrame) -> DataFrame:
    """``bounds`` stretched to what is known of the same sessions."""
    known = existing.filter("is_active").select(
        F.col("sessionId").alias("_session"), F.col("StartTime").alias("_start"), F.col("EndTime").alias("_end")
    )
    return bounds.join(known, F.col("sessionId").eqNullSafe(F.col("_session")), "left").select(
        "sessionId", F.least("StartTime", "_start").alias("StartTime"), F.greatest("EndTime", "_end").alias("EndTime")
    )


def session_dimension(plays: DataFrame, effective: date, existing: DataFrame | None = None) -> DataFrame:
    """First build, or the type-2 merge of the session bounds into ``existing``.

    A known session only grows, so ``plays`` may be those of one load.
    """
    bounds = session_bounds(plays)
    if existing is None:
        return dense_keys(as_first_version(bounds, effective), SESSION_ORDER, "session_id")
    bounds = _widened(bounds, existing)
    return merge_versions(
        existing, bounds, ["sessionId"], ["StartTime", "EndTime"], "session_id", SESSION_ORDER, effective
    )


def session_changes(plays: DataFrame, effective: date, existing: DataFrame) -> VersionChanges:
    """What the same merge changes; closed versions are not read, but for their highest key."""
    active = existing.filter("is_active").drop("year", "month")
    return version_changes(
        active,
        _widened(session_bounds(plays), active),
        ["sessionId"],
        ["StartTime", "EndTime"],
        "session_id",
        SESSION_ORDER,
        effective,
        highest_key(existing, "session_id"),
    )


def with_start_month(sessions: DataFrame) -> DataFrame:
    """Add the ``year`` and ``month`` of the start, to partition the stored table by."""
    return sessions.withColumns({"year": F.year("StartTime"), "month": F.month("StartTime")})
