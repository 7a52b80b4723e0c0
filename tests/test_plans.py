"""Every query with SQL gives DuckDB's rows."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pytest

from millrace import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (int, float, Decimal)):
        return "nan" if math.isnan(v) else float(v) + 0.0
    return str(v)


def rows_of(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([plain(r[i]) for i in order] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_same_rows_as_sql(spark, db, name):
    df = plans.queries()[name](spark, SF)
    want = db.sql(plans.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows_of(df.collect(), df.columns) == rows_of(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(plans.oracle_sql())))
def test_without_sql_is_repeatable(spark, name):
    f = plans.queries()[name]
    first = f(spark, SF)
    assert sorted(map(str, first.collect())) == sorted(map(str, f(spark, SF).collect()))
