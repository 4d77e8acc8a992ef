"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    ok, note = compare(spark, duck, FOLDER, QUERIES[name], ORACLE[name])
    assert ok, note


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


def test_entry_returns_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
