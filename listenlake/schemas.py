"""Topic schemas and schema assertions.

Field names, order and types are fixed values: they are the wire contract of
the four topics. ``userId`` is BIGINT everywhere, so that ids above 2^31-1
survive in all topics.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "BIGINT": LongType(),
    "INT": IntegerType(),
    "DOUBLE": DoubleType(),
    "STRING": StringType(),
    "BOOLEAN": BooleanType(),
}


def _schema(columns: str) -> StructType:
    """Nullable columns from ``name TYPE, ...``; needs no running session."""
    pairs = [column.split() for column in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


AUTH_EVENTS = _schema(
    "ts BIGINT, sessionId INT, level STRING, itemInSession INT, city STRING, zip STRING, "
    "state STRING, userAgent STRING, lon DOUBLE, lat DOUBLE, userId BIGINT, lastName STRING, "
    "firstName STRING, gender STRING, registration BIGINT, success BOOLEAN"
)

LISTEN_EVENTS = _schema(
    "artist STRING, song STRING, duration DOUBLE, ts BIGINT, sessionId INT, auth STRING, "
    "level STRING, itemInSession INT, city STRING, zip STRING, state STRING, userAgent STRING, "
    "lon DOUBLE, lat DOUBLE, userId BIGINT, lastName STRING, firstName STRING, gender STRING, "
    "registration BIGINT"
)

PAGE_VIEW_EVENTS = _schema(
    "ts BIGINT, sessionId INT, page STRING, auth STRING, method STRING, status INT, level STRING, "
    "itemInSession BIGINT, city STRING, zip STRING, state STRING, userAgent STRING, lon DOUBLE, "
    "lat DOUBLE, userId BIGINT, lastName STRING, firstName STRING, gender STRING, "
    "registration BIGINT, artist STRING, song STRING, duration DOUBLE"
)

STATUS_CHANGE_EVENTS = _schema(
    "ts BIGINT, sessionId INT, auth STRING, level STRING, itemInSession INT, city STRING, "
    "zip STRING, state STRING, userAgent STRING, lon DOUBLE, lat DOUBLE, userId BIGINT, "
    "lastName STRING, firstName STRING, gender STRING, registration BIGINT"
)

TOPIC_SCHEMAS: dict[str, StructType] = {
    "auth_events": AUTH_EVENTS,
    "listen_events": LISTEN_EVENTS,
    "page_view_events": PAGE_VIEW_EVENTS,
    "status_change_events": STATUS_CHANGE_EVENTS,
}


# Columns that lake tables have besides those of their topic.
QUALITY, REASON, RAW = "quality", "bad_reason", "raw_value"


def lake_schema(topic_schema: StructType) -> StructType:
    """Columns of a stored lake table, partition columns last."""
    return StructType(
        [
            *topic_schema.fields,
            StructField(REASON, StringType()),
            StructField(RAW, StringType()),
            StructField("registration_date", DateType()),
            StructField(QUALITY, StringType()),
            StructField("event_date", DateType()),
        ]
    )


def known_topics(topics: Iterable[str]) -> tuple[list[str], list[str]]:
    """Split requested topics into those with a schema and those without."""
    wanted = list(dict.fromkeys(topics))
    return [t for t in wanted if t in TOPIC_SCHEMAS], [t for t in wanted if t not in TOPIC_SCHEMAS]


def require_columns(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Return ``frame`` unchanged, or raise naming every missing column."""
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return frame
