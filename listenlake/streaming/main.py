"""Stream the event topics from Kafka to the lake.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version> \\
        --py-files listenlake.zip listenlake/streaming/main.py --brokers host:9092 --lake gs://bucket/output \\
        --checkpoints gs://bucket/checkpoints --interval "2 minutes"

Paths may lie on any file system Spark knows; credentials come from its configuration.
"""

from __future__ import annotations

import argparse
import logging

from listenlake.functions.masking import MASK_SEED
from listenlake.schemas import TOPIC_SCHEMAS, known_topics
from listenlake.session import build_session
from listenlake.sources.kafka import stream_topics
from listenlake.streaming.ingest import archive_topic, ingest_topic, run_topics
from listenlake.streaming.supervise import StreamWatch, supervise

log = logging.getLogger("listenlake.ingest")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Stream event topics from Kafka to the lake")
    parser.add_argument("--brokers", default="localhost:9092")
    parser.add_argument("--topics", default=",".join(TOPIC_SCHEMAS))
    parser.add_argument("--lake", required=True, help="folder for the tables, one per topic")
    parser.add_argument("--checkpoints", required=True, help="folder for the checkpoints, one per topic")
    parser.add_argument("--interval", default="2 minutes", help="trigger interval; empty: catch up and end")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--strict", action="store_true", help="set rows with a wrong-typed field aside")
    parser.add_argument("--max-offsets-per-trigger", type=int, help="most messages of a topic in one batch")
    parser.add_argument("--mask-seed", default=MASK_SEED, help="what masked registrations depend on besides the user")
    parser.add_argument("--repeats-within", help='leave out messages repeated within such a time, like "1 hour"')
    parser.add_argument("--allow-data-loss", action="store_true", help="go on when messages expired unread")
    return parser.parse_args(argv)


def source_overrides(args: argparse.Namespace) -> dict[str, str]:
    """Kafka source options that the arguments set."""
    overrides = {"failOnDataLoss": "false"} if args.allow_data_loss else {}
    if args.max_offsets_per_trigger:
        overrides["maxOffsetsPerTrigger"] = str(args.max_offsets_per_trigger)
    return overrides


def wanted_topics(text: str) -> list[str]:
    """The known topics of a comma-separated list; raises if there is none."""
    topics, unknown = known_topics([name.strip() for name in text.split(",") if name.strip()])
    for topic in unknown:
        log.warning("no schema for topic %s, skipped", topic)
    if not topics:
        raise ValueError(f"no known topic in {text!r}")
    return topics


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    topics = wanted_topics(args.topics)
    spark = build_session("listenlake-ingest")

    def start(messages, topic):
        if args.format == "csv":
            return archive_topic(messages, topic, args.lake, args.checkpoints, args.interval or None)
        return ingest_topic(
            messages, topic, args.lake, args.checkpoints, args.interval or None, args.strict, args.mask_seed, args.repeats_within
        )

    overrides = source_overrides(args)
    queries = run_topics(topics, lambda topic: stream_topics(spark, args.brokers, [topic], **overrides), start)
    supervise(spark, queries, StreamWatch())


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    main()
