"""Topics to lake: parse, set bad messages aside, enrich, append.

A lake table is one Parquet file sink, partitioned by ``quality`` (``good`` or
``bad``) and ``event_date``. Good and bad rows come from one pass over the
topic and are committed by the same micro-batch, so a restart neither loses
nor repeats rows on either side. The pipeline is narrow: it has no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StringType, StructField, StructType

from listenlake.functions.masking import MASK_SEED, masked_date
from listenlake.functions.times import DAY_MS, EARLIEST_MS, LATEST_MS, utc_date
from listenlake.schemas import QUALITY, RAW, REASON, TOPIC_SCHEMAS
from listenlake.streaming.compact import read_lake_rows
from listenlake.streaming.supervise import supervise

GOOD, BAD = "good", "bad"

# Quotes inside a text are doubled; a NULL is written as \N, so that an empty text stays one.
CSV_OPTIONS = {"header": "true", "escape": '"', "nullValue": "\\N"}

_CORRUPT = "_corrupt"
_TIME, _MESSAGE = "_time", "_message"


def topic_rows(messages: DataFrame, topic: str) -> DataFrame:
    return messages.filter(F.col("topic") == topic)


def parse_topic(
    messages: DataFrame,
    topic: str,
    schema: StructType,
    strict: bool = False,
    earliest_ms: int = EARLIEST_MS,
    latest_ms: int = LATEST_MS,
) -> DataFrame:
    """Messages of ``topic`` as ``schema`` columns plus quality, reason and raw text.

    Bad messages keep only their raw text and a reason: ``null_value`` (no text),
    ``malformed_json`` (no JSON object) or ``bad_time`` (``ts`` is no whole number, or
    outside ``earliest_ms..latest_ms``; without any ``ts`` a row is good). Another field of
    the wrong type is NULL and the row is good, with its raw text and the reason
    ``wrong_type``; with ``strict`` it is bad.
    """
    with_corrupt = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    text = F.col("value").cast("string")
    parsed = topic_rows(messages, topic).select(
        text.alias(RAW),
        F.from_json(text, with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT}).alias("data"),
    )
    nothing_read = F.coalesce(*[F.col(f"data.{name}").cast("string") for name in schema.names]).isNull()
    corrupt = F.col(f"data.{_CORRUPT}").isNotNull()
    reason = F.when(F.col("data").isNull(), "null_value").when(corrupt & nothing_read, "malformed_json")
    if "ts" in schema.names:
        ts = F.col("data.ts")
        unread = ts.isNull() & F.get_json_object(RAW, "$.ts").isNotNull()
        reason = reason.when(unread | ~ts.between(earliest_ms, latest_ms), "bad_time")
    reason = reason.when(corrupt, "wrong_type")
    judged = parsed.withColumn(REASON, reason)
    good = F.col(REASON).isNull()
    if not strict:
        good = good | (F.col(REASON) == "wrong_type")
    return judged.select(
        *[F.when(good, F.col(f"data.{name}")).alias(name) for name in schema.names],
        F.when(good, GOOD).otherwise(BAD).alias(QUALITY),
        REASON,
        F.when(F.col(REASON).isNotNull(), F.col(RAW)).alias(RAW),
    )


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(QUALITY) == GOOD).drop(QUALITY, REASON, RAW)


def bad_rows(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col(QUALITY) == BAD).select(RAW, REASON)


def enrich(rows: DataFrame, seed: str = MASK_SEED) -> DataFrame:
    """Add ``registration_date`` (a masked date per user) and ``event_date`` (UTC date of ``ts``).

    ``registration`` is overwritten by the start of the masked date, so that the true time of
    registration is nowhere in what is stored; a missing one stays missing. Who knows the
    ``seed`` can tell the masked dates of an id, so jobs give one of their own.
    """
    mask = masked_date(F.col("userId"), seed=seed)
    added = {"registration_date": mask, "event_date": utc_date(F.col("ts"))}
    if "registration" in rows.columns:
        masked_ms = F.datediff(mask, F.lit("1970-01-01").cast("date")).cast("bigint") * DAY_MS
        added["registration"] = F.when(F.col("registration").isNotNull(), masked_ms)
    return rows.withColumns(added)


def enriched_schema(topic: str) -> StructType:
    """The columns of a topic's good rows after ``enrich``."""
    added = [StructField("registration_date", DateType()), StructField("event_date", DateType())]
    return StructType([*TOPIC_SCHEMAS[topic].fields, *added])


def without_repeats(parsed: DataFrame, topic_schema: StructType, within: str) -> DataFrame:
    """``parsed`` without good messages that repeat an earlier one, however often and in whatever batch.

    Messages are equal if all their fields are. A stream remembers a message for ``within`` after
    its time; one that comes later than that behind the newest message is left out too, as it
    can no longer be told from a repeated one, and counted in the query's progress as dropped
    by the watermark. Bad messages and those without a time all stay. The topic is read twice a
    batch, as repeats are looked for in one part only.
    """
    timed = (F.col(QUALITY) == GOOD) & F.col("ts").isNotNull()
    message = F.sha2(F.to_json(F.struct(*topic_schema.names)), 256)
    keyed = parsed.filter(timed).withColumns({_TIME: F.timestamp_millis("ts"), _MESSAGE: message})
    first = keyed.withWatermark(_TIME, within).dropDuplicatesWithinWatermark([_MESSAGE]).drop(_TIME, _MESSAGE)
    return first.unionByName(parsed.filter(~timed))


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    interval: str | None = "2 minutes",
    file_format: str = "parquet",
    partition_by: tuple[str, ...] = (),
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start an appending file sink; ``interval=None`` takes what is there and ends."""
    writer = (
        rows.writeStream.format(file_format)
        .options(**dict(options or {}))
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def ingest_topic(
    messages: DataFrame,
    topic: str,
    lake: str,
    checkpoints: str,
    interval: str | None = "2 minutes",
    strict: bool = False,
    seed: str = MASK_SEED,
    repeats_within: str | None = None,
) -> StreamingQuery:
    """Start the pipeline of one topic: parse, leave out repeats if asked to, enrich, append to ``lake/topic``."""
    parsed = parse_topic(messages, topic, TOPIC_SCHEMAS[topic], strict)
    if repeats_within:
        parsed = without_repeats(parsed, TOPIC_SCHEMAS[topic], repeats_within)
    return append_stream(
        enrich(parsed, seed), f"{lake}/{topic}", f"{checkpoints}/{topic}", interval, partition_by=(QUALITY, "event_date")
    )


def archive_topic(
    messages: DataFrame,
    topic: str,
    archive: str,
    checkpoints: str,
    interval: str | None = "2 minutes",
) -> StreamingQuery:
    """Append the messages of one topic as CSV with a header per file; bad ones as raw text."""
    return append_stream(
        parse_topic(messages, topic, TOPIC_SCHEMAS[topic]),
        f"{archive}/{topic}",
        f"{checkpoints}/{topic}",
        interval,
        file_format="csv",
        partition_by=(QUALITY,),
        options={**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"},
    )


def run_topics(
    topics: list[str],
    source: Callable[[str], DataFrame],
    start: Callable[[DataFrame, str], StreamingQuery],
) -> list[StreamingQuery]:
    """Start one query per topic, each on a source of its own, so no topic is read twice.

    If one cannot start, those started before are stopped and the error is raised.
    """
    started: list[StreamingQuery] = []
    try:
        for topic in topics:
            started.append(start(source(topic), topic))
    except Exception:
        for query in started:
            query.stop()
        raise
    return started


def wait_for(queries: list[StreamingQuery]) -> None:
    """Wait until all queries have ended; the first failure stops the others at once and is raised."""
    supervise(SparkSession.active(), queries)


def read_lake(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Good rows of a lake table, compacted dates from their large files; filters on ``event_date`` prune its folders."""
    return good_rows(read_lake_rows(spark, path, topic))


def read_quarantine(spark: SparkSession, path: str, topic: str) -> DataFrame:
    return bad_rows(read_lake_rows(spark, path, topic))


def read_archive(spark: SparkSession, path: str, topic: str) -> DataFrame:
    """Good rows of a CSV archive, typed by the topic schema."""
    fields = [*TOPIC_SCHEMAS[topic].fields, *[StructField(c, StringType()) for c in (REASON, RAW, QUALITY)]]
    return good_rows(
        spark.read.schema(StructType(fields))
        .options(**CSV_OPTIONS, multiLine="true")
        .csv(path)
    )
