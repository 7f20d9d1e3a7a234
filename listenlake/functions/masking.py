"""Repeatable stand-in dates for personal dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


# What the masked dates depend on besides the identity, unless a job gives another.
MASK_SEED = "listenlake"


def masked_date(
    identity: Column,
    start: date = date(2021, 1, 1),
    end: date = date(2021, 12, 31),
    seed: str = MASK_SEED,
) -> Column:
    """A date in ``start..end`` (both included) that depends only on ``seed`` and ``identity``.

    The same identity always gets the same date, so a retried batch writes the
    same rows again. A NULL identity gets the date of the bare seed.
    """
    days = (end - start).days + 1
    if days < 1:
        raise ValueError(f"end {end} lies before start {start}")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(identity.cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.date_add(F.lit(start), F.pmod(draw, F.lit(days)).cast("int"))
