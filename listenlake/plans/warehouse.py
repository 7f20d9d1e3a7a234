"""A folder of stored tables that hand results from one job to the next."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from listenlake.functions.times import utc_date
from listenlake.operators.scd2 import as_first_version, new_members
from listenlake.plans import calendars, dimensions, users
from listenlake.plans.checks import require_equal, require_unique, totals
from listenlake.plans.facts import PLAY_COLUMNS, Star, fact_by_day, fact_by_hour
from listenlake.plans.sketches import daily_sketches
from listenlake.sources.tables import (
    ALL,
    NONE,
    between_dates,
    dates_note,
    dates_predicate,
    drop_old_versions,
    drop_torn_versions,
    fold_dates,
    fold_versions,
    is_applied,
    layers,
    of_dates,
    read_version,
    versions,
    write_version,
)


@dataclass(frozen=True)
class Layout:
    """How a table is stored and what identifies its rows (its active ones, if it has versions)."""

    natural: tuple[str, ...]
    partition_by: tuple[str, ...] = ()
    bucket_by: str | None = None


LAYOUTS = {
    "dim_song": Layout(tuple(dimensions.SONG_KEY)),
    "dim_artist": Layout(tuple(dimensions.ARTIST_KEY), ("is_active",)),
    "dim_city": Layout(tuple(dimensions.CITY_KEY)),
    "dim_device": Layout(("userAgent",)),
    "dim_session": Layout(("sessionId",), ("is_active", "year", "month"), "sessionId"),
    "dim_date": Layout(("Date",), ("Year", "Month")),
    "dim_date_hour": Layout(("DateSK",), ("Year", "Month")),
    "dim_user_history": Layout((*users.PERSON, "rowActivationDate", "level"), ("currentRow",)),
    "dim_user": Layout(("userId",), (), "userId"),
}

# Dimensions that only ever get new members: those of some plays (and the date of first versions),
# and the surrogate key.
_GROWING: dict[str, tuple[Callable[[DataFrame, date], DataFrame], str]] = {
    "dim_song": (lambda plays, effective: dimensions.song_members(plays), "song_id"),
    "dim_artist": (lambda plays, effective: as_first_version(dimensions.artist_members(plays), effective), "artist_id"),
    "dim_city": (lambda plays, effective: dimensions.city_members(plays), "city_id"),
    "dim_device": (lambda plays, effective: dimensions.device_members(plays), "device_id"),
}

# How a dimension follows from all that is known: the plays of a load, the date of new versions
# and the stored rows (None at first).
_WHOLE: dict[str, Callable[[DataFrame, date, DataFrame | None], DataFrame]] = {
    "dim_song": lambda plays, effective, stored: dimensions.song_dimension(plays),
    "dim_artist": lambda plays, effective, stored: dimensions.artist_dimension(plays, effective),
    "dim_city": lambda plays, effective, stored: dimensions.city_dimension(plays),
    "dim_device": lambda plays, effective, stored: dimensions.device_dimension(plays),
    "dim_session": lambda plays, effective, stored: dimensions.with_start_month(
        dimensions.session_dimension(plays, effective)
    ),
    "dim_date": lambda plays, effective, stored: calendars.day_calendar(_dates(plays, stored)),
    "dim_date_hour": lambda plays, effective, stored: calendars.hour_calendar(_dates(plays, stored)),
}

# The users' history and what is read off it come last.
DIMENSIONS = [*_WHOLE, "dim_user_history", "dim_user"]


def _dates(plays: DataFrame, calendar: DataFrame | None) -> DataFrame:
    return calendars.with_stored(calendars.range_of_plays(plays), calendar)


def _month(year: int | None, month: int | None) -> str:
    return "none" if year is None else f"{year:04d}-{month:02d}"


def _ends(sessions: DataFrame) -> dict[str, str]:
    """Last date of the active sessions that start in a month, by month: one row a month is collected."""
    last = F.date_format(F.max("EndTime"), "yyyy-MM-dd").alias("last")
    found = sessions.filter("is_active").groupBy("year", "month").agg(last).collect()
    return {_month(row.year, row.month): row["last"] or "" for row in found}


class Warehouse:
    """Tables under ``root``, built from ``plays``, the good rows of the listen_events lake.

    ``table`` reads a dimension, and builds and stores it first if it never was.
    ``refresh`` stores what the plays of the dates ``first..last`` add (all plays, if no dates are
    given; ``loaded``, if these are read already); keys given before stay as they are.
    ``load_facts`` replaces the facts of a range of dates, ``append_facts`` adds some.

    Writes cost what they add: songs, artists, cities and devices append their new members,
    sessions rewrite the months in which one changed, facts one range of dates. A ``token`` names
    a write: one that a committed version already bears is not done again.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        plays: DataFrame,
        effective: date,
        first: date | None = None,
        last: date | None = None,
        loaded: DataFrame | None = None,
    ) -> None:
        if (first is None) != (last is None):
            raise ValueError("give both ends of the dates to load, or none")
        self.spark = spark
        self.root = root
        self.plays = plays
        self.effective = effective
        self.first = first
        self.last = last
        if loaded is None:
            loaded = plays if first is None else of_dates(plays, first, last)
        self.loaded = loaded
        self._checked: dict[str, int] = {}

    # --- dimensions -------------------------------------------------------------------

    def table(self, name: str) -> DataFrame:
        return self._stored(name) or self.refresh(name)

    def refresh(self, name: str, token: str | None = None) -> DataFrame:
        """Store what this load adds to ``name``.

        Songs, artists, cities and devices are appended to, sessions grow by new versions,
        calendars grow, users keep their key and their history goes on. A load may be late or
        repeated; only the users' history then reads on to the last date that was ever loaded.
        """
        path = f"{self.root}/{name}"
        if token is None or not is_applied(self.spark, path, token):
            drop_torn_versions(self.spark, path)
            stored = self._stored(name)
            if stored is not None and name in _GROWING:
                members, key = _GROWING[name]
                added = new_members(stored, members(self.loaded, self.effective), list(LAYOUTS[name].natural), key)
                self._write(name, added, NONE, token)
            elif stored is not None and name == "dim_session":
                self._write_sessions(stored, token)
            else:
                self._write(name, self._whole(name, stored), ALL, token)
            layout = LAYOUTS[name]
            fold_versions(self.spark, path, self._schema(name), layout.partition_by)
            drop_old_versions(self.spark, path)
        return self._stored(name)

    def refresh_all(self, token: str | None = None) -> None:
        for name in DIMENSIONS:
            self.refresh(name, token)

    def _whole(self, name: str, stored: DataFrame | None) -> DataFrame:
        if name == "dim_user":
            return users.user_dimension(self.table("dim_user_history"), stored)
        if name == "dim_user_history":
            return self._history(stored)
        return _WHOLE[name](self.loaded, self.effective, stored)

    def _write_sessions(self, stored: DataFrame, token: str | None) -> None:
        """Closed versions and new ones, and the months of those that were closed anew."""
        changes = dimensions.session_changes(self.loaded, self.effective, stored)
        start_month = dimensions.with_start_month
        months = start_month(changes.replaced).select("year", "month").distinct().collect()
        touched = " OR ".join(f"(year <=> {m.year or 'NULL'} AND month <=> {m.month or 'NULL'})" for m in months)
        rows = start_month(changes.closed.unionByName(changes.added))
        if months:
            rows = rows.unionByName(start_month(changes.kept).filter(touched))
        self._write("dim_session", rows.select(*stored.columns), f"is_active AND ({touched})" if months else NONE, token)

    def _write(self, name: str, frame: DataFrame, replaces: str, token: str | None) -> None:
        layout, path = LAYOUTS[name], f"{self.root}/{name}"
        if replaces == NONE and token is None and frame.isEmpty():
            return
        buckets = None
        if layout.bucket_by:
            dealt = [note["buckets"] for note in layers(self.spark, path).values() if "buckets" in note]
            n = dealt[-1][1] if dealt else int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            buckets = (layout.bucket_by, n)
        note = {"schema": frame.schema.jsonValue()}
        if name == "dim_session":
            note["ends"] = _ends(frame)
        write_version(frame, path, layout.partition_by, replaces, token, note, buckets)

    def _history(self, stored: DataFrame | None) -> DataFrame:
        if self.first is None:
            return users.user_history(self.plays)
        days = self._stored("dim_date")
        known = None if days is None else days.agg(F.max("Date")).first()[0]
        plays = between_dates(self.plays, self.first, max(self.last, known or self.last))
        return users.user_history(plays, stored, self.first)

    def _schema(self, name: str) -> StructType:
        notes = list(layers(self.spark, f"{self.root}/{name}").values())
        return StructType.fromJson(notes[-1]["schema"])

    def _stored(self, name: str) -> DataFrame | None:
        path = f"{self.root}/{name}"
        if not versions(self.spark, path):
            return None
        layout = LAYOUTS.get(name, Layout((), ("event_date",)))
        return read_version(self.spark, path, self._schema(name), None, layout.partition_by)

    # --- facts ------------------------------------------------------------------------

    def _unique(self, name: str) -> DataFrame:
        """The rows of ``name`` that facts look up; raises if two have the natural key. Once a version."""
        rows = self.table(name)
        if "is_active" in rows.columns:
            rows = rows.filter("is_active")
        newest = versions(self.spark, f"{self.root}/{name}")[-1]
        if self._checked.get(name) != newest:
            require_unique(rows, list(LAYOUTS[name].natural), name)
            self._checked[name] = newest
        return rows

    def star(self, by_hour: bool, with_device: bool = False) -> Star:
        """The dimensions that facts point to, each unique in the key that they are looked up by."""
        return Star(
            song=self._unique("dim_song"),
            artist=self._unique("dim_artist"),
            city=self._unique("dim_city"),
            calendar=self._unique("dim_date_hour" if by_hour else "dim_date"),
            user=self._unique("dim_user"),
            session=self._unique("dim_session"),
            device=self._unique("dim_device") if with_device else None,
        )

    def star_of_dates(self, first: date, last: date, by_hour: bool) -> Star:
        """The same for plays of the dates ``first..last`` alone: months in which none of these can be are not read.

        Active sessions know all their plays, if the dates have been refreshed. So those of a
        play of these dates start in a month up to that of ``last``, whose sessions do not all
        end before ``first``.
        """
        star = self.star(by_hour)
        ends: dict[str, str] = {}
        for note in layers(self.spark, f"{self.root}/dim_session").values():
            for month, end in note.get("ends", {}).items():
                ends[month] = max(end, ends.get(month, end))
        months = [m for m, end in ends.items() if m != "none" and m <= _month(last.year, last.month) and end >= str(first)]
        wanted = " OR ".join(f"(year = {int(m[:4])} AND month = {int(m[5:])})" for m in sorted(months)) or "false"
        bounds = (12 * d.year + d.month for d in (first, last))
        in_months = (12 * F.col("Year") + F.col("Month")).between(*bounds)
        return replace(star, session=star.session.filter(wanted), calendar=star.calendar.filter(in_months))

    def facts(self, by_hour: bool) -> DataFrame:
        """The facts that were loaded; there must be some."""
        return self._stored(_fact_table(by_hour))

    def load_facts(self, first: date, last: date, by_hour: bool, token: str | None = None) -> DataFrame:
        """Replace the facts of the dates ``first..last`` and those without a date; doing so twice changes nothing.

        The plays are read for these dates only: their ``event_date`` prunes folders. Plays
        without a date are replaced by every load. Dates that have no play any more have no
        fact afterwards. All of it is one commit: readers see the facts before or after. Rows and
        durations are summed while they are written, and nothing is committed if those of the
        facts are not those of the plays.
        """
        plays = of_dates(self.plays, first, last)
        self.star(by_hour)  # built, if they never were
        dated_only = plays.filter("event_date IS NULL").isEmpty()
        star = self.star_of_dates(first, last, by_hour) if dated_only else self.star(by_hour)
        span = [str(first), str(last)]
        note = {"replaced_dates": span, **({"dates": span} if dated_only else {})}
        return self._write_facts(plays, star, by_hour, dates_predicate(first, last), token, note)

    def append_facts(self, plays: DataFrame, by_hour: bool, token: str | None = None) -> DataFrame:
        """Add the facts of ``plays``, which must be new ones."""
        return self._write_facts(plays, self.star(by_hour), by_hour, NONE, token, dates_note(plays))

    def fold_facts(self, before: date, by_hour: bool, most: int = 20) -> None:
        """Bring together the facts of dates before ``before`` that came in many small versions."""
        path = f"{self.root}/{_fact_table(by_hour)}"
        fold_dates(self.spark, path, self._schema(_fact_table(by_hour)), before, most)
        drop_old_versions(self.spark, path)

    # --- sketches ---------------------------------------------------------------------

    def sketches(self) -> DataFrame:
        """Stored sketches, one row or more a date; there must be some."""
        return self._stored("daily_sketches")

    def load_sketches(self, first: date, last: date) -> DataFrame:
        """Replace the sketches of the dates ``first..last``: these dates of the plays are read once and never again."""
        span = [str(first), str(last)]
        replaces = dates_predicate(first, last, undated=False)
        note = {"dates": span, "replaced_dates": span}
        return self._write_sketches(between_dates(self.plays, first, last), replaces, None, note)

    def append_sketches(self, plays: DataFrame, token: str | None = None) -> DataFrame:
        """Add the sketches of ``plays``: what is counted over a date merges its sketches without loss."""
        return self._write_sketches(plays, NONE, token, dates_note(plays))

    def _write_sketches(self, plays: DataFrame, replaces: str, token: str | None, note: dict) -> DataFrame:
        path = f"{self.root}/daily_sketches"
        if token is None or not is_applied(self.spark, path, token):
            made = daily_sketches(plays)
            note = {**note, "schema": made.schema.jsonValue()}
            write_version(made, path, ["event_date"], replaces, token, note)
            drop_old_versions(self.spark, path)
        return self.sketches()

    def _write_facts(
        self, plays: DataFrame, star: Star, by_hour: bool, replaces: str, token: str | None, note: dict
    ) -> DataFrame:
        path = f"{self.root}/{_fact_table(by_hour)}"
        if token is None or not is_applied(self.spark, path, token):
            measured = ["duration"] if by_hour else []
            seen, made = Observation(), Observation()
            build = fact_by_hour if by_hour else fact_by_day
            counted = plays.select(*PLAY_COLUMNS).observe(seen, *totals(measured))
            rows = build(counted, star).withColumn("event_date", utc_date(F.col("ts")))
            write_version(
                rows.hint("rebalance", F.col("event_date")).observe(made, *totals(measured)),
                path,
                ["event_date"],
                replaces,
                token,
                {**note, "schema": rows.schema.jsonValue()},
                before_commit=lambda: require_equal(seen.get, made.get, plays, rows, measured),
            )
        return self.facts(by_hour)


def _fact_table(by_hour: bool) -> str:
    return "fact_by_hour" if by_hour else "fact_by_day"
