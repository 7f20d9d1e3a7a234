import json
import time
from datetime import date

import pytest
from pyspark.sql import functions as F

from listenlake.schemas import LISTEN_EVENTS, TOPIC_SCHEMAS
from listenlake.session import kafka_package
from listenlake.sources.kafka import kafka_options
from listenlake.sources.messages import MESSAGE_SCHEMA, as_messages, read_messages, stream_messages
from listenlake.streaming import ingest
from listenlake.streaming import main as driver

TOPIC = "listen_events"


def sent(spark, *values, topic=TOPIC):
    data = [(topic, None if v is None else bytearray(v if isinstance(v, bytes) else v.encode())) for v in values]
    return spark.createDataFrame(data, MESSAGE_SCHEMA)


def event(i, **more):
    return json.dumps({"ts": 1_704_067_200_000 + i, "userId": i, "song": f"s{i}", "zip": 123, **more})


def test_good_and_bad_messages(spark):
    big = 3_000_000_000
    messages = sent(
        spark, event(1), event(big), "not json", None, "", '{"ts":1,"song":', "[1]", "null", '{"ts":"abc","song":"x"}', "{}"
    ).unionByName(sent(spark, event(7), topic="auth_events"))
    parsed = ingest.parse_topic(messages, TOPIC, LISTEN_EVENTS)
    good = ingest.good_rows(parsed)
    assert good.columns == LISTEN_EVENTS.names
    assert sorted((tuple(r) for r in good.select("ts", "userId", "song", "zip").collect()), key=str) == sorted(
        [
            (1_704_067_200_001, 1, "s1", "123"),
            (1_704_067_200_000 + big, big, f"s{big}", "123"),
            (None, None, None, None),  # an empty object is an event without fields
        ],
        key=str,
    )
    bad = sorted((tuple(r) for r in ingest.bad_rows(parsed).collect()), key=str)
    assert bad == sorted(
        [
            ("not json", "malformed_json"),
            (None, "null_value"),
            ("", "null_value"),
            ('{"ts":1,"song":', "malformed_json"),
            ("[1]", "malformed_json"),
            ("null", "malformed_json"),
            ('{"ts":"abc","song":"x"}', "bad_time"),
        ],
        key=str,
    )


@pytest.mark.parametrize("ts", ["9223372036854775807", "9223372036854775808", "1704067200000000", "-1", '"abc"', "1.5"])
def test_impossible_times_are_set_aside(spark, ts):
    text = f'{{"ts":{ts},"song":"x"}}'
    lake = ingest.enrich(ingest.parse_topic(sent(spark, text, event(1)), TOPIC, LISTEN_EVENTS))
    assert ingest.good_rows(lake).count() == 1
    assert [tuple(r) for r in ingest.bad_rows(lake).collect()] == [(text, "bad_time")]


def test_a_lost_field_leaves_its_text(spark):
    text = '{"ts":1704067200000,"sessionId":"x","song":"y"}'
    row = ingest.parse_topic(sent(spark, text), TOPIC, LISTEN_EVENTS).first()
    assert (row["quality"], row["song"], row["sessionId"]) == ("good", "y", None)
    assert (row["bad_reason"], row["raw_value"]) == ("wrong_type", text)


def test_strict_sets_wrong_types_aside(spark):
    messages = sent(spark, event(1), event(2, lon="x"), event(3, sessionId=3_000_000_000))
    parsed = ingest.parse_topic(messages, TOPIC, LISTEN_EVENTS, strict=True)
    assert ingest.good_rows(parsed).count() == 1
    assert {r["bad_reason"] for r in ingest.bad_rows(parsed).collect()} == {"wrong_type"}


def test_empty_topic(spark):
    parsed = ingest.parse_topic(sent(spark), TOPIC, LISTEN_EVENTS)
    assert parsed.isEmpty()


def test_the_json_is_read_once_per_message(spark):
    rows = ingest.enrich(ingest.parse_topic(sent(spark, event(1)), TOPIC, LISTEN_EVENTS))
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_enrich(spark):
    rows = ingest.enrich(ingest.good_rows(ingest.parse_topic(sent(spark, event(1), event(1), event(2)), TOPIC, LISTEN_EVENTS)))
    got = rows.select("userId", "registration_date", "event_date").distinct().orderBy("userId").collect()
    assert len(got) == 2
    assert {r["event_date"] for r in got} == {date(2024, 1, 1)}
    assert all(date(2021, 1, 1) <= r["registration_date"] <= date(2021, 12, 31) for r in got)


def drop(spark, path, *values):
    sent(spark, *values).coalesce(1).write.mode("append").parquet(path)


def catch_up(spark, tmp_path, start=ingest.ingest_topic):
    source = stream_messages(spark, str(tmp_path / "in"), files_per_batch=1)
    query = start(source, TOPIC, str(tmp_path / "lake"), str(tmp_path / "state"), None)
    ingest.wait_for([query])
    return f"{tmp_path}/lake/{TOPIC}"


def test_restarts_neither_lose_nor_repeat(spark, tmp_path):
    inbox = str(tmp_path / "in")
    drop(spark, inbox, *[event(i) for i in range(10)], "broken")
    lake = catch_up(spark, tmp_path)
    time.sleep(1)  # the file source orders by modification time
    drop(spark, inbox, *[event(i) for i in range(10, 20)], None)
    catch_up(spark, tmp_path)
    catch_up(spark, tmp_path)  # nothing new
    good = ingest.read_lake(spark, lake, TOPIC)
    assert sorted(r["userId"] for r in good.select("userId").collect()) == list(range(20))
    assert good.columns == [*LISTEN_EVENTS.names, "registration_date", "event_date"]
    bad = ingest.read_quarantine(spark, lake, TOPIC)
    assert sorted((tuple(r) for r in bad.collect()), key=str) == [("broken", "malformed_json"), (None, "null_value")]
    assert sum(1 for _ in (tmp_path / "lake" / TOPIC).glob("quality=good/event_date=2024-01-01/*.parquet")) == 2


def test_reading_a_date_prunes_folders(spark, tmp_path):
    drop(spark, str(tmp_path / "in"), event(1), event(86_400_000))
    lake = catch_up(spark, tmp_path)
    one_day = ingest.read_lake(spark, lake, TOPIC).filter(F.col("event_date") == F.lit(date(2024, 1, 2)))
    assert [r["userId"] for r in one_day.collect()] == [86_400_000]
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quality" in plan and "event_date" in plan.split("PartitionFilters")[1][:200]


def test_csv_archive_keeps_odd_texts(spark, tmp_path):
    odd = ['a "quoted" one', "two\nlines", "comma, here", "", "  padded  ", "back\\slash"]
    drop(spark, str(tmp_path / "in"), *[event(i, song=text) for i, text in enumerate(odd)], event(99, song=None), "broken")
    archive = catch_up(spark, tmp_path, ingest.archive_topic)
    got = ingest.read_archive(spark, archive, TOPIC)
    assert {r["userId"]: r["song"] for r in got.collect()} == {**dict(enumerate(odd)), 99: None}
    assert got.schema.names == LISTEN_EVENTS.names
    with_header = [p.read_text().splitlines()[0] for p in (tmp_path / "lake" / TOPIC).glob("quality=good/*.csv")]
    assert with_header and all(h.startswith("artist,song,duration,ts") for h in with_header)


def test_a_failing_query_is_raised_and_stops_the_others(spark, tmp_path):
    drop(spark, str(tmp_path / "in"), event(1))
    endless = ingest.ingest_topic(
        stream_messages(spark, str(tmp_path / "in")), TOPIC, str(tmp_path / "a"), str(tmp_path / "sa"), "1 second"
    )
    broken = ingest.append_stream(
        stream_messages(spark, str(tmp_path / "in")).select(F.raise_error(F.lit("broken")).cast("string").alias("x")),
        str(tmp_path / "b"),
        str(tmp_path / "sb"),
        "1 second",
    )
    with pytest.raises(Exception, match="broken"):
        ingest.wait_for([endless, broken])
    assert not endless.isActive


def test_every_topic_gets_its_own_source(spark, tmp_path):
    asked = []
    queries = ingest.run_topics(["a", "b"], lambda t: asked.append(t) or t, lambda frame, topic: (frame, topic))
    assert asked == ["a", "b"]
    assert queries == [("a", "a"), ("b", "b")]


def test_messages_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "x")], "ts bigint, song string")
    as_messages(rows, TOPIC).write.parquet(str(tmp_path / "m"))
    assert sorted(bytes(r["value"]).decode() for r in read_messages(spark, str(tmp_path / "m")).collect()) == [
        '{"ts":1}',
        '{"ts":2,"song":"x"}',
    ]


def test_kafka_options():
    assert kafka_options("h:9092", ["a", "b"], maxOffsetsPerTrigger="5") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "a,b",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": "5",
    }
    with pytest.raises(ValueError):
        kafka_options("h:9092", [])
    assert kafka_package("4.1.2") == "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_driver_streams_known_topics_and_skips_others(spark, tmp_path, monkeypatch, caplog, file_format):
    inbox = str(tmp_path / "in")
    both = sent(spark, event(1), "broken").unionByName(sent(spark, event(2), topic="auth_events"))
    both.write.parquet(inbox)
    monkeypatch.setattr(driver, "stream_topics", lambda spark, brokers, topics, **options: stream_messages(spark, inbox))
    driver.main(
        ["--lake", str(tmp_path / "lake"), "--checkpoints", str(tmp_path / "state"), "--interval", "",
         "--topics", "listen_events,auth_events,other", "--format", file_format]
    )
    read = ingest.read_lake if file_format == "parquet" else ingest.read_archive
    for topic, user in ((TOPIC, 1), ("auth_events", 2)):
        assert [r["userId"] for r in read(spark, f"{tmp_path}/lake/{topic}", topic).collect()] == [user]
    assert "no schema for topic other" in caplog.text
    assert not (tmp_path / "lake" / "other").exists()


def test_driver_options():
    needed = ["--lake", "l", "--checkpoints", "c"]
    assert driver.source_overrides(driver.arguments(needed)) == {}
    args = driver.arguments([*needed, "--max-offsets-per-trigger", "9", "--allow-data-loss"])
    assert driver.source_overrides(args) == {"failOnDataLoss": "false", "maxOffsetsPerTrigger": "9"}
    assert driver.wanted_topics("listen_events, auth_events,") == ["listen_events", "auth_events"]
    for nothing in ("", " , ", "other"):
        with pytest.raises(ValueError, match="no known topic"):
            driver.wanted_topics(nothing)


def test_started_queries_stop_when_one_cannot_start():
    stopped = []

    class Query:
        def stop(self):
            stopped.append(self)

    def start(frame, topic):
        if topic == "b":
            raise RuntimeError("no start")
        return Query()

    with pytest.raises(RuntimeError, match="no start"):
        ingest.run_topics(["a", "b"], lambda topic: topic, start)
    assert len(stopped) == 1


def test_driver_arguments():
    args = driver.arguments(["--lake", "gs://b/out", "--checkpoints", "gs://b/state", "--interval", "1 minute"])
    assert (args.interval, args.topics.split(",")) == ("1 minute", list(TOPIC_SCHEMAS))
