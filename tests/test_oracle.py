from pathlib import Path

import pytest

import __spark_entry__ as entry
from dimkeep import catalog
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_agrees_with_sql(spark, con, name):
    count, differences, types = compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])
    assert count > 0 and differences == []


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(catalog.oracles())
    assert set(catalog.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_grades_are_grouped_once_and_read_back(spark):
    """The state before and the merge read the kept rows, not the line items."""
    read = entry.queries()["load_fact_grade"](spark, FOLDER).inputFiles()
    assert read and not any("lineitem" in f for f in read)
