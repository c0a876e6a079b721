"""Every registered query of the warehouse against its SQL twin on the given tables."""

import os

import pytest
from oracle_compare import connect, difference

import __spark_entry__ as entry
from tallyhouse.registry.oracle import TWINS
from tallyhouse.registry.queries import registered

SF_DIR = os.environ.get("TALLYHOUSE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def twin():
    return connect(SF_DIR)


def test_names_agree():
    assert set(registered()) == set(TWINS)
    assert set(registered()) <= set(entry.queries()) and set(TWINS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", registered())
def test_query(spark, twin, name):
    assert difference(registered()[name](spark, SF_DIR), twin, TWINS[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
