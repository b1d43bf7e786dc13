"""Every registered query against the same query in SQL, on whole tables."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import DATA
from crowdtide.workload import catalog, oracle

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracle.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_same_rows(spark, sql, name):
    got = entry.queries()[name](spark, DATA)
    want = sql.sql(entry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    have = Counter(tuple(r) for r in got.select(*columns).collect())
    expected = Counter(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert sum(expected.values()) > 0
    assert have == expected


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
