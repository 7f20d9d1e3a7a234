"""Helpers that several corpus operators share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterator, Sequence
from functools import wraps
from pathlib import Path

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake.operators.scratch import materialise, scratch_path

# White space of the contracts: blank and tab to carriage return.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# What goes to a Python worker at once, unless the session asks for less: both sides hold some such batches.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}

_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, for sessions that were not started with it."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp(prefix="listenlake-")  # of the driver, which serves the archive from it
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = shutil.make_archive(str(Path(folder) / package.name), "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def _bound_batches(spark: SparkSession) -> None:
    """Lower the session's batch settings to ours; lower ones of its own stay."""
    for name, most in BATCH_SETTINGS.items():
        now = int(spark.conf.get(name).removesuffix("b"))
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def _give_back_memory() -> None:
    """Return what a task has freed to the system: its Python worker lives on, beside the heap of the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # only glibc has it


def _then_tidy(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    @wraps(function)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from function(batches)
        finally:
            _give_back_memory()

    return run


def map_pandas(frame: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    _ship_package(frame.sparkSession)
    _bound_batches(frame.sparkSession)
    return frame.mapInPandas(_then_tidy(function), schema)


def map_arrow(frame: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    _ship_package(frame.sparkSession)
    _bound_batches(frame.sparkSession)
    return frame.mapInArrow(_then_tidy(function), schema)


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``frame`` has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_fields(frame: DataFrame, ddl: str) -> StructType:
    """The schema of ``frame`` and further fields."""
    return StructType([*frame.schema.fields, *StructType.fromDDL(ddl).fields])


def stored(frame: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """``frame`` written once below ``spark.checkpoint.dir`` and read back: survives lost executors."""
    if not partition_by:
        return materialise(frame, f"llm-{label}")
    spark = frame.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    frame.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the files of a ``stored`` frame that nothing reads any more."""
    hadoop = frame.sparkSession._jvm.org.apache.hadoop.fs
    for folder in {file.rpartition("/")[0] for file in frame.inputFiles()}:
        path = hadoop.Path(folder)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def small_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of rows the driver holds; the caller states what bounds their number."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def _numbered(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Position and running sum inside each key of one sorted partition, carried from batch to batch."""
    last, rank, total = None, 0, 0
    for rows in parts:
        if rows.empty:
            continue
        groups = rows.groupby("key", sort=False)
        at = groups.cumcount().to_numpy()
        before = groups["amount"].cumsum().to_numpy() - rows["amount"].to_numpy()
        first = (rows["key"] == last).to_numpy()
        rows = rows.assign(rank=at + rank * first, before=before + total * first)
        last = rows["key"].iloc[-1]
        rank = int(rows["rank"].iloc[-1]) + 1
        total = int(rows["before"].iloc[-1]) + int(rows["amount"].iloc[-1])
        yield rows


def running(frame: DataFrame, order: list[str], label: str) -> DataFrame:
    """``frame`` with ``rank`` (0, 1, ... inside its ``key``) and ``before`` (sum of ``amount`` so far).

    ``key`` is an int and ``amount`` a long, neither null; ``order`` fixes the order inside a
    key. No task holds a whole key: rows are range-partitioned by key and order, numbered inside
    their partition and written; what precedes a partition is added afterwards from one line per
    partition and key, of which there are at most partitions + keys.
    """
    spark = frame.sparkSession
    sort = ["key", *order]
    ranged = frame.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("part", F.spark_partition_id())
    rows = stored(map_pandas(ranged, _numbered, with_fields(ranged, "rank long, before long")), label)
    lines = rows.groupBy("part", "key").agg(F.count("*").alias("n"), F.sum("amount").alias("sum")).collect()
    seen: dict[int, tuple[int, int]] = {}
    starts = []
    for line in sorted(lines, key=lambda x: (x.key, x.part)):
        rank, before = seen.get(line.key, (0, 0))
        starts.append((line.part, line.key, rank, before))
        seen[line.key] = (rank + line.n, before + line["sum"])
    offsets = small_table(spark, starts, "part int, key int, rank_start long, before_start long")
    return (
        rows.join(offsets, ["part", "key"])
        .withColumns({"rank": F.col("rank") + F.col("rank_start"), "before": F.col("before") + F.col("before_start")})
        .drop("part", "rank_start", "before_start")
    )
