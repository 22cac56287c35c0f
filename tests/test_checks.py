"""Registered queries on the smallest tables equal their SQL. The jobs among them are tested in test_jobs."""

import pytest

import __spark_entry__ as entry
from docflow.checks import registry
from tests.compare import connect, difference

FAST = [n for n in registry.QUERIES if n in registry.SQL and n[0] in "cdefghijk"]


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, db, sf_dir, name):
    rows = entry.queries()[name](spark, sf_dir).toPandas()
    assert len(rows) and difference(rows, db.execute(entry.oracle_sql()[name]).df()) is None


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "lang" and frame.count() == 4


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
