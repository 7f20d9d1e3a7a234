"""Growing a dimension: new members, and type-2 versions of changed ones."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.operators.ordering import dense_keys, highest_key
from listenlake.operators.scratch import materialise


def _all_equal(pairs: Iterable[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, [left.eqNullSafe(right) for left, right in pairs])


def as_first_version(frame: DataFrame, effective: date) -> DataFrame:
    """Add the version columns of an active row that starts on ``effective``."""
    return frame.select(
        "*",
        F.lit(effective).alias("start_date"),
        F.lit(None).cast("date").alias("end_date"),
        F.lit(True).alias("is_active"),
    )


def new_members(existing: DataFrame, incoming: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """The incoming rows with an unknown natural key, numbered after the highest key in use.

    Keys are compared NULL-safe. Only the columns of ``existing`` that are needed are read.
    """
    known = existing.select(*[F.col(c).alias(f"_known_{c}") for c in natural])
    same_member = _all_equal((F.col(c), F.col(f"_known_{c}")) for c in natural)
    new = incoming.join(known, same_member, "left_anti")
    return dense_keys(new, natural, key, start=highest_key(existing, key)).select(*existing.columns)


def append_members(existing: DataFrame, incoming: DataFrame, natural: Sequence[str], key: str) -> DataFrame:
    """Existing rows as they are, plus ``new_members``. Appending the same members twice changes nothing."""
    return existing.unionByName(new_members(existing, incoming, natural, key))


@dataclass(frozen=True)
class VersionChanges:
    """What a type-2 merge does to a table: rows that stay, versions that it closes, and versions that it adds.

    ``replaced`` are the active rows that ``closed`` stands for, as they were.
    """

    kept: DataFrame
    replaced: DataFrame
    closed: DataFrame
    added: DataFrame


def version_changes(
    active: DataFrame,
    incoming: DataFrame,
    natural: Sequence[str],
    tracked: Sequence[str],
    key: str,
    key_order: Sequence[str],
    effective: date,
    last_key: int,
) -> VersionChanges:
    """Type-2 changes that ``incoming`` (one row per natural key) makes to the ``active`` versions.

    * unchanged members and members that are not in ``incoming`` stay as they are;
    * a member whose ``tracked`` columns changed (NULL-safe) is closed on
      ``effective`` and gets a new active version;
    * an unknown member gets a first version.

    New versions get new surrogate keys, in ``key_order``, after ``last_key``. Two incoming rows
    of one natural key, or a change dated before the version it would close, raise.
    """
    columns = active.columns
    old = active.select(F.struct(*columns).alias("old"))
    new = incoming.select(F.struct(*natural, *tracked).alias("new"))
    same_member = _all_equal((F.col(f"old.{c}"), F.col(f"new.{c}")) for c in natural)
    unchanged = _all_equal((F.col(f"old.{c}"), F.col(f"new.{c}")) for c in tracked)
    # One full join decides the fate of every row; all outcomes read it back.
    fates = materialise(
        old.join(new, same_member, "full_outer").select(
            "old", "new", (F.col("old").isNotNull() & (F.col("new").isNull() | unchanged)).alias("keep")
        ),
        "merge",
    )
    twice = fates.filter(F.col("new").isNotNull()).groupBy(*[F.col(f"new.{c}") for c in natural]).count()
    if not twice.filter("count > 1").isEmpty():
        raise ValueError(f"incoming rows are not unique in {', '.join(natural)}")
    if not fates.filter(~F.col("keep") & (F.col("old.start_date") > F.lit(effective))).isEmpty():
        raise ValueError(f"versions that start after {effective} would be closed by it")

    replaced = fates.filter(~F.col("keep") & F.col("old").isNotNull()).select("old.*")
    closed = replaced.withColumns({"end_date": F.lit(effective), "is_active": F.lit(False)})
    versions = as_first_version(fates.filter("NOT keep").select("new.*"), effective)
    added = dense_keys(versions, key_order, key, start=last_key)
    return VersionChanges(
        kept=fates.filter("keep").select("old.*"),
        replaced=replaced,
        closed=closed.select(*columns),
        added=added.select(*[c for c in columns if c in added.columns]),
    )


def merge_versions(
    existing: DataFrame,
    incoming: DataFrame,
    natural: Sequence[str],
    tracked: Sequence[str],
    key: str,
    key_order: Sequence[str],
    effective: date,
) -> DataFrame:
    """The whole table after ``version_changes`` to its active versions; versions closed earlier stay as they are.

    Merging the same input again changes nothing.
    """
    changes = version_changes(
        existing.filter("is_active"), incoming, natural, tracked, key, key_order, effective, highest_key(existing, key)
    )
    return (
        existing.filter("NOT is_active").unionByName(changes.kept).unionByName(changes.closed).unionByName(changes.added)
    )
