"""Stored tables whose rewrites never touch the rows being read.

A table is a folder. Every write goes to a new ``v=<n>`` folder, which counts only once the empty
file ``_committed/<n>`` exists. So a crash before the commit leaves the old rows readable, and a
job may overwrite the table that it reads.

A version says which earlier rows it replaces, by a predicate over partition columns: all of
them (the default), none, or some partitions. Readers lay the committed versions over each other
from the last that replaced everything. What a load does is one commit, however many partitions
it replaces, and costs no more than the rows it writes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

# What a version replaces: every earlier row, or none.
ALL, NONE = "true", "false"
_VERSION = "v"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Sorted numbers of the entries ``<prefix><number>`` in ``folder``; none if it is missing."""
    files, path = _file_system(spark, folder)
    if not files.exists(path):
        return []
    names = [status.getPath().getName() for status in files.listStatus(path)]
    return sorted(int(n[len(prefix) :]) for n in names if n.startswith(prefix) and n[len(prefix) :].isdigit())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Committed versions, oldest first."""
    return _numbers(spark, f"{path}/_committed", "")


def _write_note(spark: SparkSession, path: str, number: int, note: dict) -> None:
    files, target = _file_system(spark, f"{path}/{_VERSION}={number}/_note")
    out = files.create(target, True)
    try:
        out.write(bytearray(json.dumps(note).encode()))
    finally:
        out.close()


def read_note(spark: SparkSession, path: str, number: int) -> dict:
    """What the writer of a version noted; nothing if it noted nothing."""
    files, target = _file_system(spark, f"{path}/{_VERSION}={number}/_note")
    if not files.exists(target):
        return {}
    stream = files.open(target)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def layers(spark: SparkSession, path: str, number: int | None = None) -> dict[int, dict]:
    """The versions that make up the table as of ``number`` (default: now), oldest first, with their notes.

    A version all of whose dates a later one replaced is not among them.
    """
    found: dict[int, dict] = {}
    gone: list[tuple[str, str]] = []
    for version in reversed(versions(spark, path)):
        if number is not None and version > number:
            continue
        note = read_note(spark, path, version)
        dates = note.get("dates")
        if dates is None or not any(first <= dates[0] and dates[1] <= last for first, last in gone):
            found[version] = note
        if note.get("replaces", ALL) == ALL:
            break
        if "replaced_dates" in note:
            gone.append(tuple(note["replaced_dates"]))
    return dict(sorted(found.items()))


def version_of(spark: SparkSession, path: str, token: str) -> int | None:
    """The committed version that was written under ``token``."""
    return next((n for n in reversed(versions(spark, path)) if read_note(spark, path, n).get("token") == token), None)


def is_applied(spark: SparkSession, path: str, token: str) -> bool:
    """Whether a committed version was written under ``token``."""
    return version_of(spark, path, token) is not None


def write_version(
    frame: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    replaces: str = ALL,
    token: str | None = None,
    note: dict | Callable[[], dict] | None = None,
    buckets: tuple[str, int] | None = None,
    before_commit: Callable[[], None] | None = None,
) -> int:
    """Write ``frame`` as the next version and commit it; returns its number.

    ``replaces`` is the predicate of the earlier rows that are gone with it. ``buckets`` (column,
    number) deals the rows so that joins on the column need not move them. A ``note`` that only the
    written rows tell is a function, called after them. ``before_commit`` may
    raise: the version then never counts. Creating the commit file fails if another writer took
    the number first.
    """
    spark = frame.sparkSession
    taken = [*versions(spark, path), *_numbers(spark, path, f"{_VERSION}=")]
    number = max(taken, default=0) + 1
    folder = f"{path}/{_VERSION}={number}"
    if buckets is None:
        frame.write.mode("errorifexists").partitionBy(*partition_by).parquet(folder)
    else:
        column, n = buckets
        # Only tables of the catalog have buckets: the name goes at once, the files stay.
        name = f"written_{uuid.uuid4().hex}"
        writer = frame.repartition(n, column).write.format("parquet").bucketBy(n, column).sortBy(column)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option("path", folder).saveAsTable(name)
        spark.sql(f"DROP TABLE {name}")
    if before_commit is not None:
        before_commit()
    noted = dict((note() if callable(note) else note) or {}, replaces=replaces, token=token, buckets=buckets)
    _write_note(spark, path, number, {key: value for key, value in noted.items() if value is not None})
    commit_version(spark, path, number)
    return number


def commit_version(spark: SparkSession, path: str, number: int) -> None:
    files, marker = _file_system(spark, f"{path}/_committed/{number}")
    files.create(marker, False).close()


def read_version(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    number: int | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """The rows of the table as of one version (default: the newest).

    A table without commits has no rows, given a schema. Without one, the schema
    is that of the files, and the table must exist. A version whose files cannot
    be read raises. If all versions are dealt into the same buckets, and schema and partition
    columns are given, the frame keeps the buckets.
    """
    known = versions(spark, path)
    if number is None and not known:
        if schema is None:
            raise ValueError(f"no version of {path} was committed")
        return spark.createDataFrame([], schema)
    if number is not None and number not in known:
        raise ValueError(f"version {number} of {path} was not committed")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    laid = layers(spark, path, number)
    dealt = {tuple(note.get("buckets") or ()) for note in laid.values()}
    if schema is not None and len(dealt) == 1 and (bucket := dealt.pop()):
        frame = _bucketed(spark, path, schema, partition_by, *bucket)
        frame = frame.filter(F.col(_VERSION).isin(list(laid)))
    else:
        reader = spark.read
        if schema is not None:
            reader = reader.schema(StructType([*schema.fields, StructField(_VERSION, IntegerType())]))
        frame = reader.option("basePath", path).parquet(*[f"{path}/{_VERSION}={n}" for n in laid])
    for version, note in laid.items():
        replaces = note.get("replaces", ALL)
        if replaces not in (ALL, NONE):
            frame = frame.filter((F.col(_VERSION) >= version) | ~F.coalesce(F.expr(replaces), F.lit(False)))
    return frame.drop(_VERSION) if schema is None else frame.select(*schema.names)


@contextmanager
def _listed_partitions(spark: SparkSession) -> Iterator[None]:
    """Partitions of new tables are those that their folder has, not those that the catalog was told of."""
    setting = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _bucketed(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str], column: str, n: int
) -> DataFrame:
    """All versions of a bucketed table, as a frame that knows its buckets and needs no name in the catalog any more."""
    name = f"read_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    folders = ", ".join(f"`{c}`" for c in (_VERSION, *partition_by))
    with _listed_partitions(spark):
        spark.sql(
            f"CREATE TABLE {name} ({columns}, `{_VERSION}` INT) USING parquet PARTITIONED BY ({folders}) "
            f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {n} BUCKETS LOCATION '{path}'"
        )
        frame = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return frame


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Delete all versions but the newest ``keep`` and those they lie upon, the commit file first; returns what went."""
    if keep < 1:
        raise ValueError("keep at least one version")
    known = versions(spark, path)
    needed = {version for number in known[-keep:] for version in layers(spark, path, number)}
    old = [number for number in known if number not in needed]
    for number in old:
        for folder in (f"{path}/_committed/{number}", f"{path}/{_VERSION}={number}"):
            files, target = _file_system(spark, folder)
            files.delete(target, True)
    return old


def drop_torn_versions(spark: SparkSession, path: str) -> list[int]:
    """Delete what writers left that died before their commit; no writer may be at work. Returns what went."""
    torn = sorted({*_numbers(spark, path, f"{_VERSION}=")} - {*versions(spark, path)})
    for number in torn:
        files, target = _file_system(spark, f"{path}/{_VERSION}={number}")
        files.delete(target, True)
    return torn


def fold_versions(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = (), most: int = 20
) -> bool:
    """Rewrite a table of more than ``most`` layers as one version; whether it did."""
    laid = layers(spark, path)
    if len(laid) <= most:
        return False
    last = list(laid.values())[-1]
    bucket = last.get("buckets")
    note: dict = {}
    for layer in laid.values():
        for key, value in layer.get("ends", {}).items():
            note.setdefault("ends", {})[key] = max(value, note.get("ends", {}).get(key, value))
    write_version(
        read_version(spark, path, schema, None, partition_by),
        path,
        partition_by,
        note=note,
        buckets=tuple(bucket) if bucket else None,
    )
    return True


def dates_predicate(first: date, last: date, column: str = "event_date", undated: bool = True) -> str:
    """SQL for rows of a date range, and for those without a date, which belong to every load."""
    between = f"{column} BETWEEN DATE'{first}' AND DATE'{last}'"
    return f"{between} OR {column} IS NULL" if undated else between


def dates_note(dates: DataFrame, column: str = "event_date") -> dict:
    """The first and last date of rows as a note of their version; nothing if some have none."""
    return dates_found(dates.agg(*dates_seen(column)).first().asDict())


def dates_seen(column: str = "event_date") -> list[Column]:
    """What ``dates_found`` needs to know of rows. Rows that a write counts twice change nothing in it."""
    return [F.min(column).alias("first"), F.max(column).alias("last"), F.count_if(F.col(column).isNull()).alias("undated")]


def dates_found(found: dict) -> dict:
    return {} if found["undated"] or found["first"] is None else {"dates": [str(found["first"]), str(found["last"])]}


def fold_dates(
    spark: SparkSession, path: str, schema: StructType, before: date, most: int = 20, column: str = "event_date"
) -> int | None:
    """Bring together what many small versions hold of the dates before ``before``; the number of the new version.

    Only if the table has more than ``most`` versions that were not folded yet. The dates that
    these have rows for are written once more, as one version; the older ones are not read any
    more once all their dates are in it, and ``drop_old_versions`` deletes them.
    """
    fresh = [note["dates"] for note in layers(spark, path).values() if "dates" in note and not note.get("folded")]
    closed = [dates for dates in fresh if dates[1] < str(before)]
    if len(fresh) <= most or not closed:
        return None
    first, last = (date.fromisoformat(day) for day in (min(d[0] for d in closed), max(d[1] for d in closed)))
    rows = between_dates(read_version(spark, path, schema), first, last, column)
    span = [str(first), str(last)]
    note = {"schema": schema.jsonValue(), "dates": span, "replaced_dates": span, "folded": True}
    replaces = dates_predicate(first, last, column, undated=False)
    return write_version(rows.hint("rebalance", F.col(column)), path, [column], replaces, note=note)


def replace_partitions(frame: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write the partitions that ``frame`` has rows for, replacing only those.

    Running the same increment twice leaves the same table. The rows are
    brought together by partition first, split where one is large, so that a
    partition is neither one task nor a swarm of small files.
    """
    (
        frame.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def of_dates(frame: DataFrame, first: date, last: date, column: str = "event_date") -> DataFrame:
    """Rows of a date range and rows without a date, which belong to every load."""
    return frame.filter(F.col(column).between(F.lit(first), F.lit(last)) | F.col(column).isNull())


def between_dates(frame: DataFrame, first: date, last: date, column: str = "event_date") -> DataFrame:
    """Rows of a date range: prunes the folders of a table partitioned by the date."""
    return frame.filter(F.col(column).between(F.lit(first), F.lit(last)))
