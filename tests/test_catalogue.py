"""Every query against its DuckDB oracle at the smallest scale."""

import importlib

import duckdb
import pytest

from tests.conftest import DATA

from siltbed.plans.catalogue import QUERIES
from siltbed.plans.oracles import ORACLES

entry_module = importlib.import_module("__spark_entry__")
SF_DIR = DATA / "sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    connection.execute(f"create view events as select * from '{SF_DIR}/events.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_registers_the_catalogue():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    frame = entry_module.queries()[name](spark, str(SF_DIR))
    columns = sorted(frame.columns)
    got = sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)
    result = oracle.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted((tuple(row[names.index(c)] for c in columns) for row in result.fetchall()), key=repr)
    assert got and got == expected
