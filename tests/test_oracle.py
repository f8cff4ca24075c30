"""Every registered query against its DuckDB oracle (the driver's gate), on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_registry_covers_survey_index():
    assert len(QUERIES) >= 111
    assert set(SQL) <= set(QUERIES)


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
                 "array<string>": "VARCHAR[]"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(SQL[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    cur = duck.execute(SQL[name])
    dcols, drows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert cols == dcols
    assert len(rows) == len(drows)
    assert rows == drows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "pct_within_spread" in df.columns
