"""Every registered query against its SQL on the same tables."""

import os

import pytest
from compare import assert_same, open_tables

import __spark_entry__ as entry
from tidewright.plans.analogues import QUERIES
from tidewright.plans.oracles import ORACLES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return open_tables(FOLDER)


# Those of the training data have tests of their own.
NAMES = sorted(QUERIES)


def test_each_query_has_sql():
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) == set(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    assert_same(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name])


def test_entry(spark):
    assert entry.entry(spark).count() > 0
