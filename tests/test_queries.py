"""Every registered query against its SQL, on the whole small data."""

import pytest

import __spark_entry__ as entry_points
from pathloom.catalog.queries import ORACLES, QUERIES
from tools.check_queries import compare


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, small, name):
    assert compare(spark, con, name, small) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    found = entry_points.entry(spark)
    assert {"dataset", "split", "scene", "pedestrian", "start"} <= set(found.columns)
    assert found.count() > 0
