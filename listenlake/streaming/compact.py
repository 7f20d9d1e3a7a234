"""Small files of a lake table, rewritten for closed dates into a table of its own that readers prefer."""

from __future__ import annotations

import re
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlake.schemas import QUALITY, TOPIC_SCHEMAS, lake_schema
from listenlake.sources.tables import (
    dates_predicate,
    drop_torn_versions,
    layers,
    read_version,
    versions,
    write_version,
)

TARGET_BYTES = 256 << 20
_DATE_FOLDER = re.compile(r"/event_date=(\d{4}-\d{2}-\d{2})/")


def compacted_path(lake_table: str) -> str:
    return f"{lake_table.rstrip('/')}_compacted"


def _raw(spark: SparkSession, lake_table: str, topic: str) -> DataFrame:
    return spark.read.schema(lake_schema(TOPIC_SCHEMAS[topic])).parquet(lake_table)


def _inside(lake_table: str, file: str) -> str:
    """The part of a file's address below the lake table's folder, as partitions and name."""
    return "/".join(part for part in unquote(file).rsplit("/", 3)[1:] if part)


def compact_dates(
    spark: SparkSession, lake_table: str, topic: str, first: date, last: date, target_bytes: int = TARGET_BYTES
) -> int | None:
    """Rewrite the dates ``first..last`` of a lake table in files of about ``target_bytes``; the version, if any.

    What the streaming sink has committed is read, and the list of its files is kept with the
    rewritten rows: a file is read in one form or the other, never both. So rows that arrive
    late for a date are read from their small files until the date is compacted again. A crash
    before the commit changes nothing for readers.
    """
    raw = _raw(spark, lake_table, topic)
    files = [f for f in raw.inputFiles() if (m := _DATE_FOLDER.search(f)) and str(first) <= m[1] <= str(last)]
    if not files:
        return None
    path = compacted_path(lake_table)
    drop_torn_versions(spark, path)
    # The files just listed and no others: the sink may commit more meanwhile.
    rows = spark.read.schema(raw.schema).option("basePath", lake_table).parquet(*files).select(*raw.columns)
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, str(target_bytes))
    try:
        return write_version(
            rows.hint("rebalance", F.col(QUALITY), F.col("event_date")),
            path,
            [QUALITY, "event_date"],
            dates_predicate(first, last, undated=False),
            note={
                "files": sorted(_inside(lake_table, f) for f in files),
                "dates": [str(first), str(last)],
                "replaced_dates": [str(first), str(last)],
            },
        )
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def read_lake_rows(spark: SparkSession, lake_table: str, topic: str) -> DataFrame:
    """All rows of a lake table, good and bad: compacted dates from their large files, the rest from the sink's."""
    raw = _raw(spark, lake_table, topic)
    path = compacted_path(lake_table)
    if not versions(spark, path):
        return raw
    compacted = read_version(spark, path, raw.schema)
    covered = {file for note in layers(spark, path).values() for file in note["files"]}
    rest = [file for file in raw.inputFiles() if _inside(lake_table, file) not in covered]
    if not rest:
        return compacted
    left = spark.read.schema(raw.schema).option("basePath", lake_table).parquet(*rest)
    return compacted.unionByName(left.select(*raw.columns))
