"""Queries with SQL twins, on the given tables."""

import pytest
from oracle_compare import connect, difference

from tallyhouse.llm import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", registry.TWINS)
def test_twin(spark, name):
    assert difference(registry.QUERIES[name](spark, SF_DIR), connect(SF_DIR), registry.TWINS[name]) is None


def test_all_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
