"""Tables written between two steps of one job.

Some operators must read an intermediate result twice and see the same rows
both times, also after executors were lost. They write it once as Parquet to
the shared folder named by ``spark.checkpoint.dir`` and read it back, which
also cuts the lineage and gives later joins true file sizes to plan with.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}
_on_clear: list[Callable[[], None]] = []


def on_clear(action: Callable[[], None]) -> None:
    """Have ``action`` called when the scratch folder is cleared, to forget what pointed there."""
    _on_clear.append(action)


def scratch_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables."""
    app_id = spark.sparkContext.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/listenlake/{app_id}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app_id not in _local_roots:
        folder = tempfile.mkdtemp(prefix="listenlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_roots[app_id] = folder
    return _local_roots[app_id]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path of its own for one intermediate table."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(frame: DataFrame, label: str) -> DataFrame:
    """Write ``frame`` once and return a frame that reads the written rows."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables; call when the job is over."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(scratch_root(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    for action in _on_clear:
        action()
