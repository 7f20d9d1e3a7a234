from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import settings
from listenlake.functions.agents import device_columns
from listenlake.functions.masking import masked_date
from listenlake.functions.times import date_key, epoch_millis, hour_key, utc_date, utc_hour, utc_second
from listenlake.schemas import TOPIC_SCHEMAS, known_topics, require_columns

MOMENTS = [(0,), (-1,), (-1500,), (86_399_999,), (86_400_000,), (1_704_067_207_179,), (None,)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_dates_and_hours_ignore_the_session_zone(spark, zone):
    with settings(spark, {"spark.sql.session.timeZone": zone}):
        rows = (
            spark.createDataFrame(MOMENTS, "ms bigint")
            .select(utc_date(F.col("ms")), utc_hour(F.col("ms")), F.unix_millis(utc_second(F.col("ms"))))
            .collect()
        )
    assert [tuple(row) for row in rows] == [
        (date(1970, 1, 1), 0, 0),
        (date(1969, 12, 31), 23, -1000),
        (date(1969, 12, 31), 23, -2000),
        (date(1970, 1, 1), 23, 86_399_000),
        (date(1970, 1, 2), 0, 86_400_000),
        (date(2024, 1, 1), 0, 1_704_067_207_000),
        (None, None, None),
    ]


def test_epoch_millis_floors(spark):
    rows = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 7, 179999),)], "t timestamp_ntz")
    assert rows.select(epoch_millis("t")).first()[0] == 1_704_067_207_179


def test_calendar_keys(spark):
    row = spark.range(1).select(
        date_key(F.lit(date(2021, 3, 4))).alias("day"), hour_key(F.lit(date(2021, 3, 4)), F.lit(5)).alias("hour")
    )
    assert tuple(row.first()) == (20210304, 2021030405)
    assert dict(row.dtypes) == {"day": "int", "hour": "bigint"}


def test_device_columns(spark):
    agents = [
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 7_1 like Mac OS X) Mobile Safari/9537", "iPhone", "iPhone", "Safari"),
        ("Mozilla/5.0 (Windows NT 6.1) Chrome/36.0 Safari/537.36", "Unknown", "Windows", "Chrome"),
        ("Mozilla/5.0 (Linux; Android 4) Mobile Firefox/9", "Mobile", "Linux", "Firefox"),
        ("curl/7.1", "Unknown", "Unknown", "Unknown"),
        ("", "Unknown", "Unknown", "Unknown"),
        (None, "Unknown", "Unknown", "Unknown"),
    ]
    parsed = spark.createDataFrame([(a[0],) for a in agents], "agent string").select(
        *device_columns(F.col("agent")).values()
    )
    assert [tuple(row) for row in parsed.collect()] == [a[1:] for a in agents]


def test_masked_date_is_repeatable_and_covers_its_range(spark):
    users = spark.range(20_000).withColumnRenamed("id", "userId")
    draw = users.select("userId", masked_date(F.col("userId")).alias("d"))
    assert draw.exceptAll(users.repartition(7).select("userId", masked_date(F.col("userId")))).isEmpty()
    low, high, different = draw.agg(F.min("d"), F.max("d"), F.countDistinct("d")).first()
    assert (low, high, different) == (date(2021, 1, 1), date(2021, 12, 31), 365)
    other = users.select("userId", masked_date(F.col("userId"), seed="other").alias("e"))
    assert draw.join(other, "userId").filter("d <> e").count() > 19_000
    assert spark.range(1).select(masked_date(F.lit(None))).first()[0] is not None
    with pytest.raises(ValueError):
        masked_date(F.lit(1), date(2021, 2, 1), date(2021, 1, 1))


def test_schema_registry():
    assert known_topics(["listen_events", "nope", "auth_events", "listen_events"]) == (
        ["listen_events", "auth_events"],
        ["nope"],
    )
    assert {name: len(schema) for name, schema in TOPIC_SCHEMAS.items()} == {
        "auth_events": 16,
        "listen_events": 19,
        "page_view_events": 22,
        "status_change_events": 16,
    }
    assert all(f.nullable for schema in TOPIC_SCHEMAS.values() for f in schema)


def test_required_columns_are_named(spark):
    frame = spark.range(1).withColumn("ts", F.lit(1))
    assert require_columns(frame, ["id", "ts"]) is frame
    with pytest.raises(ValueError, match="sessionId, userId"):
        require_columns(frame, ["sessionId", "ts", "userId"])
