"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from terrasieve.plans.catalog import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def rounded(rows):
    return sorted(repr(tuple(round(v, 3) if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, db, name):
    want = db.sql(SQL[name])
    columns = sorted(want.columns)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert rounded(got.select(columns).collect()) == rounded(want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
