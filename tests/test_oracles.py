"""Every registered query against its SQL statement on the smallest data."""

from __future__ import annotations

import os

import pytest
from compare import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from skyweave.bindings.oracles import ORACLES
from skyweave.bindings.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ok, note = compare(spark, duck, SF, name)
    assert ok, note


def test_entry(spark):
    assert entry(spark).count() > 0
