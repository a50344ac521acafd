"""Every registered query against DuckDB on the driver's tables."""

import os

import pytest

import __spark_entry__ as entry
from conftest import DATA
from oracle import assert_same, duck

SF = os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.001")


@pytest.mark.parametrize("name", entry.core_queries())
def test_query_equals_duckdb(spark, name):
    assert_same(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name])


def test_every_query_has_an_oracle():
    assert entry.core_queries().keys() == entry.core_oracle_sql().keys()


def test_entry_is_the_flagship_report(spark):
    assert entry.entry(spark).count() == 76
