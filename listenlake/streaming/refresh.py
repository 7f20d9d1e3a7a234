"""A warehouse that follows the stream of plays, micro-batch by micro-batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from listenlake.plans.warehouse import Warehouse
from listenlake.sources.tables import (
    NONE,
    dates_found,
    dates_seen,
    drop_old_versions,
    drop_torn_versions,
    fold_dates,
    read_version,
    version_of,
    versions,
    write_version,
)

PLAYS = "plays"


def apply_batch(batch: DataFrame, token: str, root: str, by_hour: bool = True, most: int = 20) -> None:
    """Bring the warehouse under ``root`` up to date with the plays of one micro-batch, once.

    The plays are stored first; dimensions and facts follow from what was stored, in one commit a
    table that bears the batch's ``token``. A batch that comes again after a crash finds the
    tables that it reached and goes on with the others; its own rows are read from where they
    were stored. Versions begin on the last date that was ever seen. More than ``most`` small
    versions of closed dates are brought together.
    """
    spark = batch.sparkSession
    path = f"{root}/{PLAYS}"
    number = version_of(spark, path, token)
    if number is None:
        drop_torn_versions(spark, path)
        # Its dates are seen while it is stored: the source is read once, and no executor keeps it in memory.
        seen = Observation()
        rows = batch.observe(seen, *dates_seen()).hint("rebalance", F.col("event_date"))
        schema = batch.schema.jsonValue()
        number = write_version(rows, path, ["event_date"], NONE, token, lambda: {"schema": schema, **dates_found(seen.get)})
    mine = spark.read.schema(batch.schema).parquet(f"{path}/v={number}").select(*batch.columns)
    dates = mine.agg(F.min("event_date").alias("first"), F.max("event_date").alias("last")).first()
    if dates["first"] is None:
        # Without a date no dimension can place them: they are stored, and in the facts of the next batch job.
        return
    plays = read_version(spark, path, batch.schema)
    effective = _latest(Warehouse(spark, root, plays, dates["last"]), dates["last"])
    store = Warehouse(spark, root, plays, effective, dates["first"], dates["last"], mine)
    store.refresh_all(token)
    store.append_facts(mine, by_hour, token)
    store.append_sketches(mine, token)
    store.fold_facts(effective, by_hour, most)
    fold_dates(spark, path, batch.schema, effective, most)
    # The plays of the last batch must stay readable by their own version until the next one is committed.
    drop_old_versions(spark, path)


def _latest(store: Warehouse, last: date) -> date:
    """The later of ``last`` and the last date that the calendar knows."""
    if not versions(store.spark, f"{store.root}/dim_date"):
        return last
    known = store.table("dim_date").agg(F.max("Date")).first()[0]
    return max(last, known or last)


def refresh_stream(
    plays: DataFrame,
    root: str,
    checkpoint: str,
    by_hour: bool = True,
    interval: str | None = "2 minutes",
    name: str = "plays",
    most: int = 20,
) -> StreamingQuery:
    """Start the query that applies the stream ``plays`` (good rows, enriched) to the warehouse.

    ``name`` and the number of a micro-batch, which the checkpoint remembers, make its token: two
    streams into one warehouse need different names, and one warehouse needs one checkpoint.
    ``interval=None`` takes what is there and ends.
    """

    def apply(batch: DataFrame, number: int) -> None:
        apply_batch(batch, f"{name}-{number}", root, by_hour, most)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        plays.writeStream.queryName(name)
        .foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
