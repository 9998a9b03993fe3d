"""Every registered plan against its DuckDB oracle at sf0.01 (names, types, rows, exact values)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tallyframe.sources import TABLES

from .conftest import SF001, SF01

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
TYPES = {"LongType": "BIGINT", "IntegerType": "INTEGER", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
         "BooleanType": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert [f.name for f in df.schema.fields] == ["user_id", "outcome", "n", "prob"]
    assert SF001


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) > 0
        return
    rel = con.execute(ORACLE[name])
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    dtypes = dict(r[:2] for r in con.execute(f"DESCRIBE {ORACLE[name]}").fetchall())
    for f in df.schema.fields:
        assert TYPES.get(type(f.dataType).__name__, f.dataType.simpleString()) == dtypes[f.name], f.name
    assert len(rows) == len(drows)
    assert _canon(df.columns, rows) == _canon(dcols, drows)
