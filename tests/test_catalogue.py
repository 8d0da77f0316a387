"""Each query with SQL is held against DuckDB on the test tables."""

import decimal
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from leafmill.plans import catalogue


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(data).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, data, duck, name):
    df = catalogue.QUERIES[name](spark, data)
    result = duck.execute(catalogue.SQL[name])
    columns = [c[0] for c in result.description]
    order = sorted(columns)
    assert sorted(df.columns) == order
    expected = sorted((tuple(plain(r[columns.index(c)]) for c in order) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr) == expected


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql(spark, data, name):
    assert catalogue.QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 20
    assert set(entry.oracle_sql()) <= set(entry.queries())
