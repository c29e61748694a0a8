"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry_module
from noticeloom.plans import catalog

from .compare import difference, duck

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Queries that find nothing in the smallest tables are compared on larger ones.
LARGER = "/root/testdata/sf0.01"
WITHOUT_ROWS = {"similar_titles"}
ORACLES = catalog.ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, con, name):
    verdict = difference(catalog.QUERIES[name](spark, SF), con, ORACLES[name])
    if verdict == "no rows" and name in WITHOUT_ROWS:
        verdict = difference(catalog.QUERIES[name](spark, LARGER), duck(LARGER), ORACLES[name])
    assert verdict == ""


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
