"""Every registered query against its SQL twin, whole results."""

import importlib.util
import sys

import pytest
from compare import connect, spark_result, sql_result

import __spark_entry__ as driver
from martpulse.catalog.oracle import SQL
from martpulse.catalog.queries import ALL as QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_same_result(spark, con, folder, name):
    columns, rows = spark_result(QUERIES[name](spark, folder))
    sql_columns, sql_rows = sql_result(con, SQL[name])
    assert columns == sql_columns
    assert rows and rows == sql_rows


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["martpulse.llm", "corpus_pipeline", "martpulse.llm.queries", "xxhash"])
def test_entry_without_the_optional_subpackage(monkeypatch, missing):
    """Whether the folders are gone, empty, or lack something they need: the other queries stay."""
    for name in [m for m in sys.modules if m.startswith(("martpulse.llm", "corpus_pipeline", "xxhash"))]:
        monkeypatch.delitem(sys.modules, name)
    import martpulse

    monkeypatch.delattr(martpulse, "llm", raising=False)
    monkeypatch.setitem(sys.modules, missing, None)
    spec = importlib.util.spec_from_file_location("entry_alone", driver.__file__)
    alone = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(alone)
    assert alone.queries() == QUERIES and alone.oracle_sql() == SQL
