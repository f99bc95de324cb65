"""Every registered query against its SQL twin at sf0.01, with no tolerance beyond six digits."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from oracles import ORACLES as LIBRARY_ORACLES
from rejoinder.plans.catalog import CATALOG

PATH = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.01")
ORACLES = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(PATH)


def test_every_query_has_a_twin():
    assert set(CATALOG) == set(LIBRARY_ORACLES)
    assert set(entry_points.queries()) >= set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(entry_points.queries()[name](spark, PATH), duck, ORACLES[name]) == []


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0
