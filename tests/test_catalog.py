"""Every query gives the rows of its SQL."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from catalog.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as con:
        yield con


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert difference(df, duck, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert QUERIES and QUERIES.keys() == ORACLES.keys()
    assert entry.queries().keys() >= QUERIES.keys()


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
