"""Not-null conditions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def all_known(columns: Iterable[str]) -> Column:
    """True where no column is NULL; unlike ``dropna`` it is pushed down to the Parquet scan."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
