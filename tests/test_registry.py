"""Every registered query against its SQL, over the whole small tables."""

import pytest

import __spark_entry__ as entry_points
from registry.oracles import ORACLES
from registry.queries import QUERIES
from tests.conftest import SF_DIR
from tools.check import connect, differs


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    got = entry_points.queries()[name](spark, SF_DIR).toPandas()
    assert len(got) > 0
    assert differs(got, con.sql(entry_points.oracle_sql()[name]).df()) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1377
