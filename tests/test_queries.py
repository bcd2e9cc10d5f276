"""Every registered query against its SQL text, on the smallest tables."""

from __future__ import annotations

import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect
from workload.oracles import SQL
from workload.registry import QUERIES

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, connection, name):
    same, note = compare(spark, connection, TABLES, name)
    assert same, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_entry_without_the_optional_operators():
    """The other queries are there when the training-data operators are not installed."""
    code = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == "tidelake.llm" or name.startswith("tidelake.llm."):
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as e
from workload.registry import QUERIES
assert set(e.queries()) == set(QUERIES) == set(e.oracle_sql())
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
