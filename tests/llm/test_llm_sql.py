"""Registered queries of the corpus package against their SQL, on whole tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest
from conftest import DATA

from crowdtide.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def rounded(rows):
    return Counter(tuple(round(v, 6) if isinstance(v, float) and math.isfinite(v) else v for v in r) for r in rows)


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows(spark, sql, name):
    got = QUERIES[name](spark, DATA)
    want = sql.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    expected = rounded(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert sum(expected.values()) > 0
    assert rounded(tuple(r) for r in got.select(*columns).collect()) == expected
