"""Comparing a registered query with its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb

# Every table of a test-data folder becomes a view.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        file = Path(sf_dir) / f"{name}.parquet"
        if file.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return connection


def sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Rows with columns in name order, themselves sorted; values of equal meaning made equal."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda row: tuple((v is None, str(v)) for v in row))


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int | float):
        return float(value)
    return value


def spark_rows(frame) -> tuple[list[str], list[tuple]]:
    return sorted_rows(frame.columns, [tuple(row) for row in frame.collect()])


def duck_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted_rows(names, cursor.fetchall())
