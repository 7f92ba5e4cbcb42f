"""Every query with SQL gives the rows of its SQL, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.catalog import model_queries, oracle, table_queries

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    db = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_sql_has_a_query_and_every_query_an_sql():
    assert set(ORACLE) <= set(QUERIES)
    assert set(oracle.ORACLE) == {*table_queries.QUERIES, *model_queries.QUERIES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
