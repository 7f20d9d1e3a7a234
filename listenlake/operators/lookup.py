"""Surrogate-key lookup: facts to a dimension by natural key."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_key(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    key: str,
    as_name: str | None = None,
) -> DataFrame:
    """Left equi join that adds one dimension column to every fact row.

    ``on`` maps fact columns to dimension columns; a NULL in any of them finds
    no row and gives a NULL key. The dimension must be unique in its natural
    key. Whether it is broadcast is left to Spark's size check; a frequent key
    in a shuffled join is split by the adaptive skew join.
    """
    natural = {f"_natural_{i}": column for i, column in enumerate(on.values())}
    members = dimension.select(
        *[F.col(column).alias(name) for name, column in natural.items()],
        F.col(key).alias(as_name or key),
    )
    matches = [facts[fact] == members[name] for fact, name in zip(on, natural)]
    return facts.join(members, matches, "left").drop(*natural)
