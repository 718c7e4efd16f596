"""Every registered query against DuckDB on the smallest test tables."""

import importlib
import inspect
from pathlib import Path

import pytest

from checks import compare, oracle, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", queries.registry())
def test_query(spark, con, name):
    count, problem = compare.difference(spark, con, name, SF)
    assert problem is None
    assert count > 0


def test_entry_points(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).columns[:3] == ["ticker", "interval", "timestamp"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(queries.registry()) == set(oracle.statements())
    assert all(len(inspect.signature(q).parameters) == 2 for q in entry.queries().values())
    assert oracle.statements().keys()
