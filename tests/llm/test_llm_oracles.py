"""Corpus queries against their SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from compare import duck, duck_rows, spark_rows
from listenlake.llm.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    assert spark_rows(entry.queries()[name](spark, SF_DIR)) == duck_rows(duck(SF_DIR), ORACLES[name])
