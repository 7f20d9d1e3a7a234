"""User dimension: history of the subscription level, and the current row."""

from __future__ import annotations

from datetime import UTC, date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.functions.nulls import all_known
from listenlake.functions.times import utc_second
from listenlake.operators.ordering import LARGE, dense_keys, large_groups, of_groups
from listenlake.operators.runs import gathered_state_runs, state_runs
from listenlake.operators.scd2 import append_members

PERSON = ["userId", "firstName", "lastName", "gender"]
OPEN_END = "9999-12-31 00:00:00"


def one_play_per_instant(plays: DataFrame) -> DataFrame:
    """One row per (userId, ts, level), the first by session, item and names.

    A minimum over a struct, so copies are folded before the shuffle.
    """
    rest = ["sessionId", "itemInSession", "firstName", "lastName", "gender", "registration_date"]
    return (
        plays.filter(all_known(["userId", "level", "ts"]))
        .groupBy("userId", "ts", "level")
        .agg(F.min(F.struct(*rest)).alias("first"))
        .select("userId", "ts", "level", "first.*")
    )


def _runs(plays: DataFrame, open_: DataFrame | None, many: bool) -> DataFrame:
    """Stretches of plays at the same level, and of the open ones of a stored history; ``many``: users may have any number."""
    instants = one_play_per_instant(plays if many else plays.repartition("userId"))
    if open_ is not None:
        instants = instants.unionByName(open_.select(*[F.col(c).cast(kind) for c, kind in instants.dtypes]))
    return (state_runs if many else gathered_state_runs)(
        instants,
        keys=PERSON,
        order=["ts", "sessionId", "itemInSession", "level"],
        state=["level"],
        measures={"registration_date": ("min", "registration_date")},
    )


def user_history(
    plays: DataFrame, stored: DataFrame | None = None, first: date | None = None, large: int = LARGE
) -> DataFrame:
    """One row per stretch of plays of a person at the same level.

    Given a ``stored`` history, ``plays`` are those of the dates from ``first`` on. Stretches
    that another followed before ``first`` stay as they are; the one that was open then goes on
    from a play at its start; later ones are derived anew. So a late or repeated load gives
    what one load of everything gives.

    Plays of users with up to ``large`` of them move once, to one task a user; users with more
    are never gathered in one task.
    """
    plays = plays.filter(all_known(["userId", "level", "ts"]))
    listed = large_groups(plays, ["userId"], large)
    open_ = None
    if stored is not None:
        border = F.timestamp_seconds(F.lit(int(datetime(first.year, first.month, first.day, tzinfo=UTC).timestamp())))
        done = stored.filter(F.col("rowExpirationDate") < border)
        open_ = stored.filter((F.col("rowActivationDate") < border) & (F.col("rowExpirationDate") >= border))
        open_ = open_.withColumns(
            {"ts": F.unix_millis("rowActivationDate"), "sessionId": F.lit(None), "itemInSession": F.lit(None)}
        )
    if listed is None:
        runs = _runs(plays, open_, False)
    else:
        few, many = (
            [f if f is None else of_groups(f, listed, ["userId"], keep) for f in (plays, open_)] for keep in (False, True)
        )
        runs = _runs(*few, False).unionByName(_runs(*many, True))
    history = runs.select(
        *PERSON,
        "level",
        "registration_date",
        utc_second(F.col("run_start")).alias("rowActivationDate"),
        F.coalesce(utc_second(F.col("next_start")), F.lit(OPEN_END).cast("timestamp")).alias("rowExpirationDate"),
        F.col("next_start").isNull().cast("int").alias("currentRow"),
    )
    return history if stored is None else done.select(*history.columns).unionByName(history)


def user_dimension(history: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """The latest current row of each user, with a dense ``userKey``.

    A user seen under several names has a current row per name; the one
    activated last wins, then the greatest name. Users of ``existing`` keep
    their key.
    """
    rank = F.struct("rowActivationDate", "firstName", "lastName", "gender")
    latest = (
        history.filter("currentRow = 1")
        .groupBy("userId")
        .agg(F.max(F.struct(rank.alias("rank"), F.struct(*history.columns).alias("row"))).alias("latest"))
        .select("latest.row.*")
    )
    if existing is None:
        return dense_keys(latest, ["userId"], "userKey").select("userKey", *history.columns)
    keys = append_members(existing.select("userKey", "userId"), latest.select("userId"), ["userId"], "userKey")
    return latest.join(keys, "userId").select("userKey", *history.columns)
