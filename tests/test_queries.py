"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.answers import ANSWERS
from checks.compare import compare, connect
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ANSWERS)
    assert set(QUERIES) <= set(queries()) and set(ANSWERS) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ANSWERS[name]) == "ok"


def test_entry_schema(spark):
    df = entry(spark)
    assert len(df.columns) == 30 and df.count() > 0
