"""Every registered query against its SQL counterpart, on the whole small tables."""

import importlib.util
import sys

import pytest

import __spark_entry__
from __spark_entry__ import entry, oracle_sql, queries
from citeweave.catalog import ORACLES, QUERIES

from .oracle import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, con, name):
    assert differences(QUERIES[name](spark, SF), ORACLES[name], con) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_core_queries_load_without_an_optional_package(monkeypatch):
    for name in [n for n in sys.modules if n.startswith(("citeweave.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "tiktoken", None)
    spec = importlib.util.spec_from_file_location("entry_alone", __spark_entry__.__file__)
    entry_alone = importlib.util.module_from_spec(spec)
    with pytest.warns(UserWarning, match="no training-data queries"):
        spec.loader.exec_module(entry_alone)
    assert set(entry_alone.queries()) == set(QUERIES) == set(entry_alone.oracle_sql())
