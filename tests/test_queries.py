"""Every registered query against its SQL counterpart."""

import sys

import duckdb
import pytest

import __spark_entry__ as entry_point
from clickloom.oracle import ORACLE
from clickloom.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _text(value):
    return repr(value) if isinstance(value, float) else str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_result_as_sql(spark, duck, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    found = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    expected = found.fetchall()
    got = [tuple(r) for r in df.select(*names).collect()]
    assert sorted(tuple(map(_text, r)) for r in got) == sorted(tuple(map(_text, r)) for r in expected)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_export_is_ordered(spark, duck, sf_dir):
    name = "interaction_export"
    df = entry_point.queries()[name](spark, sf_dir)
    found = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert [tuple(r) for r in df.select(*names).collect()] == found.fetchall()


def test_entry_point_without_the_training_data_operators(monkeypatch):
    """Also where a folder is left over, or one of their libraries is missing."""
    monkeypatch.setitem(sys.modules, "clickloom.llm.oracle", None)
    assert entry_point.queries() == QUERIES and entry_point.oracle_sql() == ORACLE
