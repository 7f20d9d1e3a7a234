"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import duck, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duckdb_tables():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert entry.QUERIES.keys() <= entry.oracle_sql().keys()


def test_flagship(spark):
    assert entry.entry(spark).columns == ["rank", "song_id", "song_name", "song_duration", "plays"]


@pytest.mark.parametrize("name", entry.QUERIES)
def test_query_equals_its_sql(spark, duckdb_tables, name):
    assert spark_rows(entry.queries()[name](spark, SF_DIR)) == duck_rows(duckdb_tables, entry.oracle_sql()[name])
